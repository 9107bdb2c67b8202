"""CSV and Parquet in and out, views, and tables handed from one step to the next."""

import tempfile
import uuid
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabq.functions.predicates import literal, quoted
from tabq.sources import schemas

NULL_TEXT = "\\N"  # NULL in the files of write_csv, where an empty text stays an empty text
BUCKET_ROWS = 2_000_000
SPREAD_ROWS = 20_000
LINE = "_line"  # the text of a record that does not fit


def read_csv(spark, path, schema=None, trim=False, null_text=None, line=None):
    """CSV with a header line. Without a schema every column is text.

    A field that does not fit its declared type is NULL. ``trim`` drops leading blanks, which
    otherwise turn whole numbers into NULL and stay in front of text values. ``null_text`` reads the
    files of ``write_csv``. ``line`` names a text column of the schema that takes the whole record
    where a field or the number of fields does not fit, and is NULL elsewhere.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if trim:
        reader = reader.option("ignoreLeadingWhiteSpace", True)
    if null_text is not None:
        reader = reader.options(**_dialect(null_text))
    if line is not None:
        reader = reader.option("columnNameOfCorruptRecord", line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _dialect(null_text):
    return {"nullValue": null_text, "escape": '"'}


def write_csv(df, path, null_text=NULL_TEXT):
    """CSV with header lines that ``read_csv`` gives back: blanks around values stay, quotes are
    doubled, NULL and empty text differ. Values must not hold line breaks, so that files can be
    split."""
    df.write.mode("errorifexists").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        **_dialect(null_text)).csv(path)


@dataclass(frozen=True)
class Landing:
    """A scan in two parts. ``rejected`` has each record's text, ``reason`` and the fields that fit."""

    accepted: DataFrame
    rejected: DataFrame


def land_csv(spark, path, schema, name, base=None, trim=False, null_text=None):
    """Scan CSV files once with a declared schema and keep the records apart that do not fit it.

    Both parts are folders of one Parquet table in the shared folder, so a reader of one never reads
    the other, and the text is parsed once however many steps follow. ``reason`` names the columns
    whose field does not have the declared type, or says that the number of fields is wrong.
    """
    with_line = StructType([*schema.fields, StructField(LINE, StringType())])
    raw = read_csv(spark, path, with_line, trim, null_text, LINE)
    marked = raw.withColumn("_rejected", F.col(LINE).isNotNull().cast("int"))
    table = handoff(marked, name, base, partition_by=["_rejected"])
    columns = [quoted(c) for c in schema.fieldNames()]
    accepted = table.filter("_rejected = 0").select(columns)

    options = {"ignoreLeadingWhiteSpace": str(trim).lower()}
    if null_text is not None:
        options |= _dialect(null_text)
    texts = ", ".join(f"{quoted(c)} string" for c in schema.fieldNames())
    wrong = ", ".join(
        f"CASE WHEN _texts.{c} IS NOT NULL AND {c} IS NULL THEN {literal(c.strip('`'))} END"
        for c in columns)
    rejected = table.filter("_rejected = 1").withColumn("_texts", F.from_csv(LINE, texts, options))
    rejected = rejected.withColumn("_wrong", F.expr(f"concat_ws(', ', {wrong})"))
    reason = F.when(F.col("_wrong") == "", "number of fields").otherwise(F.col("_wrong"))
    return Landing(accepted, rejected.select(
        F.col(LINE).alias("line"), reason.alias("reason"), *columns))


def read_parquet(spark, path):
    return spark.read.parquet(path)


def spread(df, rows=SPREAD_ROWS):
    """The rows over parts of about ``rows`` each, for work that takes long for each byte read: the
    parts of a scan follow the bytes and row groups, so a small file is one task's."""
    parts = -(-df.count() // rows)
    return df.repartition(parts) if parts > 1 else df


def write_parquet(df, path, mode="errorifexists", partition_by=()):
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def shared_folder(spark):
    """The folder the cluster names in ``spark.checkpoint.dir``; on one machine one is set if none is."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a shared folder, or pass base")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tabq-"))
    return spark.conf.get("spark.checkpoint.dir")


def new_path(spark, name, base=None):
    """A folder that is not there yet, for a table of that name."""
    base = base or shared_folder(spark)
    if is_local(base, spark) and base != spark.conf.get("spark.checkpoint.dir", None):
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError(f"{base} is a folder of one machine; executors do not share it")
    return f"{base.rstrip('/')}/{name}/{uuid.uuid4()}"


def handoff(df, name, base=None, partition_by=()):
    """Write a table once and return it as read back, so that later steps share the work.

    The table goes to the shared folder the cluster names in ``spark.checkpoint.dir`` unless
    ``base`` names another one. It outlives lost executors and has no lineage behind it. Every call
    writes a new subfolder, so a table can be handed over under the name it was read from, and jobs
    with one name do not meet. A folder of one machine is refused unless Spark runs on one.
    """
    path = new_path(df.sparkSession, name, base)
    write_parquet(df, path, partition_by=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitioned(df, name, columns, base=None, files=1):
    """``handoff`` with one folder for each value of the columns, so that filters on them, also those
    that follow from a joined table, leave folders unread.

    Rows are first brought together by value, ``files`` parts each, spread by row number. Adaptive
    execution cuts a part that is larger than its advisory size among several tasks and merges small
    ones: no task's rows grow with the table, however large a value is, and small values do not leave
    a file for every task that met them.
    """
    part = F.pmod(F.monotonically_increasing_id(), F.lit(files))
    together = df.withColumn("_part", part).hint(
        "rebalance", *[F.col(quoted(c)) for c in columns], F.col("_part")).drop("_part")
    return handoff(together, name, base, partition_by=columns)


def bucketed(df, name, columns, buckets, base=None):
    """A copy that is laid out by the columns in ``buckets`` parts and sorted in each.

    Joins on exactly these columns with a table of as many buckets, and groups by them, need no
    shuffle of it; it is laid out once for all reports that use the key. The table's files are in the
    shared folder; the session knows it under a name of its own. All rows of a key are in one bucket,
    so a key with a large part of all rows is better joined by ``Star.join`` with ``heavy``. Adaptive
    execution has a large bucket written by several tasks, which write a file of it each.
    """
    spark = df.sparkSession
    path = new_path(spark, name, base)
    table = f"{name}_{uuid.uuid4().hex}"
    laid = df.hint("rebalance", buckets, *[F.col(quoted(c)) for c in columns])
    laid.write.format("parquet").option("path", path).bucketBy(buckets, *columns).sortBy(
        *columns).saveAsTable(table)
    return spark.table(table)


def buckets_for(df, least=1, rows=BUCKET_ROWS):
    """How many buckets hold about ``rows`` rows each, so that the task that joins one does not grow
    with the table."""
    return max(least, -(-df.count() // rows))


def is_local(path, spark):
    """Whether the path is on a machine's own disk: by its scheme, else by the default file system."""
    scheme = urlsplit(path).scheme or urlsplit(
        spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")).scheme
    return scheme == "file"


def rows(spark, values, schema):
    """A table from rows in memory. The schema is required: a column of only NULLs has no type."""
    return spark.createDataFrame(values, schema)


def prepend_rows(df, values):
    """Put hand-written text rows before a table; all columns of the result are text."""
    schema = ", ".join(f"`{c}` string" for c in df.columns)
    dirty = rows(df.sparkSession, values, schema)
    return dirty.union(df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]))


def publish(**frames):
    """Register each table under its name, so that it can be queried with SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
