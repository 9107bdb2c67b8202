"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WHITE = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fold(column: str, n: int):
    """crc32 of the value as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(n))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that all executors share; one is set only where none is (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = "/tmp/checkpoints"
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df, written once as Parquet in the shared folder and read again: a compressed checkpoint."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """df, stored in buckets by a key, so that later work on the key leaves it where it is. Only its files
    stay: the table that names them for the time of writing is dropped."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option(
        "path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def numbered(df: DataFrame, row: str) -> DataFrame:
    """df with a number of its own for each row in the column `row`, the same at every read.

    Rows of files are named by a 64-bit hash of the file and the place in it, whatever way the files are
    split. Others are numbered in their order and stored, as that order may differ when it is made anew.
    """
    try:
        return df.withColumn(row, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    except AnalysisException:
        return stored(df.withColumn(row, F.monotonically_increasing_id()))


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of bounded size, however long their texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20)


def slices(batch: pa.RecordBatch, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about `most` bytes, so that what is made of them stays small too."""
    rows = max(1, int(batch.num_rows * most / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def append(df: DataFrame, work: Callable[[pa.RecordBatch], list], fields: str,
           keep: list[str] | None = None, most: int = 4 << 20) -> DataFrame:
    """df's columns `keep` (all by default) and the arrays that `work` makes of each part of a batch,
    of about `most` bytes.

    A new column takes the place of a kept one of the same name.
    """
    new = T._parse_datatype_string(fields)
    names = {f.name for f in new}
    kept = [f for f in df.schema if (keep is None or f.name in keep) and f.name not in names]
    schema = T.StructType(kept + list(new))
    types = [f.type for f in to_arrow_schema(new)]
    old = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, most)):
            made = [x if isinstance(x, pa.Array) else pa.array(x, type=t)
                    for x, t in zip(work(part), types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in old] + made, names=old + [f.name for f in new])

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The texts as UTF-8, NULL as empty."""
    column = batch.column(name)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def column_texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts, NULL as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def runs(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours of at most `most` in total, at least one each: bounds working memory."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def folded_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(_hash, words), np.uint64, len(words))


_hash = xxhash.xxh3_64_intdigest


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point: is it a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
