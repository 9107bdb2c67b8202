"""Rule sets, cleaning steps and reports for the known tables."""
