"""Session settings the operators rely on."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan with real sizes: small partitions are merged, skewed join keys split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rule sets make wide projections. The JVM never compiles methods above 8000 bytes of code, so
    # a stage with such a method is better run without whole-stage code generation.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The driver keeps the text of every plan; one with a model's numbers in it is over a megabyte.
    "spark.sql.maxPlanStringLength": "100000",
}


def configure(spark):
    """Apply the settings to a running session; all of them can change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(name, master=None, **settings):
    """A new session, or the running one. Extra settings are given with ``__`` for the dots."""
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
