"""Data quality, cleaning and reporting over flat tables, as Spark DataFrame operators."""
