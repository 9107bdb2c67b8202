import pytest

from tabq.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__session__timeZone="UTC",
    )
    session.sparkContext.setLogLevel("OFF")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def labels_of(spark):
    """Label one column: (rule, schema, rows) to the list of labels in row order."""
    from pyspark.sql import functions as F

    def run(rule, schema, rows):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        df = spark.createDataFrame(numbered, "row int, " + schema)
        found = df.select("row", rule.column().alias("label")).orderBy("row")
        return [r["label"] for r in found.collect()]

    return run
