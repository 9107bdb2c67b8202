"""Language identification with a bit-sliced Bloom filter over letter n-grams.

One filter serves all languages: each of its rows is a bit mask, a bit per language. The AND of an
n-gram's rows names all languages that contain it, in one look-up. A text's languages are compared
by how many of its n-grams each contains, corrected for the false positives that the fill of its
slice makes likely.

An n-gram belongs to a language if it is a fixed share of that language's n-grams, and not a small
fraction of its share elsewhere. Such n-grams number at most 1 / `min_share` for a language, so the
filter has a fixed size however large the corpus is; all training texts are counted.

Defined results: NULL, empty or letterless texts are `und` with score 0; so is every text if nothing
could be learnt. A text with no known n-gram has score 0. Ties go to the language that sorts first. Equal
rows get equal results, one each. An empty table gives no rows. Columns of the input that have the
names of the new ones are replaced. Texts of any length are read whole, in pieces of bounded memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabq.llm.common import append, column_texts, letters, mix, runs, small_batches

ROWS = 1 << 22
PROBES = 3
SIZES = (3, 4)
MIN_SHARE = 1e-6  # of the language's n-grams
MIN_RATIO = 0.05  # of the n-gram's highest share in any language
PIECE = 1 << 20  # code points worked on at once
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    slices: np.ndarray  # (groups of eight languages, ROWS), a bit for each language
    fill: np.ndarray  # share of set bits, by language


def grams(text: str) -> np.ndarray:
    """Hashes of the n-grams of letters; what stands between words counts as one mark."""
    parts, step, most = [], PIECE, max(SIZES)
    for at in range(0, len(text), step):
        points = np.frombuffer(
            text[at:at + step + most].lower().encode("utf-32-le", "replace"), np.uint32)
        known = letters()[points]
        keep = known | np.concatenate(([True], known[:-1]))  # one mark for a run of others
        points = np.where(known, points, 0)[keep].astype(np.uint64)
        points = np.concatenate((np.zeros(1, np.uint64), points, np.zeros(1, np.uint64)))
        for n in SIZES:
            if len(points) < n:
                continue
            key = np.zeros(len(points) - n + 1, np.uint64)
            for i in range(n):
                key = (key << np.uint64(16)) + key * np.uint64(31) + points[i:len(points) - n + 1 + i]
            middle = points[1:len(points) - n + 2]
            parts.append(mix(key[middle > 0], n))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def rows_of(keys: np.ndarray) -> list[np.ndarray]:
    return [(mix(keys, 11 + i) % np.uint64(ROWS)).astype(np.int64) for i in range(PROBES)]


def _counted(batches):
    """(language, n-gram, count), summed over each batch."""
    for batch in batches:
        texts, languages = column_texts(batch, "text"), batch.column("lang").to_pylist()
        order = sorted(range(len(texts)), key=lambda i: languages[i])
        texts, languages = [texts[i] for i in order], [languages[i] for i in order]
        for start, end in runs([len(t) for t in texts], 4 * PIECE):
            for language in dict.fromkeys(languages[start:end]):
                own = [grams(t) for t, x in zip(texts[start:end], languages[start:end])
                       if x == language]
                keys, n = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                     pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from every text with a language. The driver gets one row for each language and at most
    ROWS filter rows."""
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text is not null and lang is not null")
    summed = rows.mapInArrow(_counted, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))
    totals = rows.mapInArrow(_totals, "lang string, n long").groupBy("lang").agg(
        F.sum("n").alias("total")).orderBy("lang").toPandas()
    languages = totals["lang"].tolist()
    slices = np.zeros(((len(languages) + 7) // 8 or 1, ROWS), np.uint8)
    if languages:
        of = F.element_at(F.create_map(*(F.lit(x) for x in sum(
            ([a, float(max(b, 1))] for a, b in zip(languages, totals["total"])), []))), F.col("lang"))
        number = F.array_position(F.lit(languages), F.col("lang")) - 1
        shares = summed.withColumn("share", F.col("n") / of).where(F.col("share") >= MIN_SHARE)
        members = shares.groupBy("gram").agg(
            F.max("share").alias("most"),
            F.collect_list(F.struct(number.alias("k"), "share")).alias("each")).select(
            "gram", F.explode(F.filter("each", lambda x: x["share"] >= MIN_RATIO * F.col("most")))
            .alias("x")).select("gram", F.col("x.k").cast("int").alias("k"))
        bits = members.mapInArrow(_bits, "part int, row int, mask int").groupBy("part", "row").agg(
            F.bit_or("mask").alias("mask")).toPandas()
        slices[bits["part"].to_numpy(), bits["row"].to_numpy()] = bits["mask"].to_numpy()
    fill = np.array([np.count_nonzero(slices[i // 8] & (1 << (i % 8))) / ROWS
                     for i in range(len(languages))])
    return Model(languages, slices, fill)


def _totals(batches):
    for batch in batches:
        n = {}
        for t, x in zip(column_texts(batch, "text"), batch.column("lang").to_pylist()):
            n[x] = n.get(x, 0) + len(SIZES) * len(t)
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()),
                                          pa.array(list(n.values()), pa.int64())], ["lang", "n"])


def _bits(batches):
    for batch in batches:
        keys = batch.column("gram").to_numpy(zero_copy_only=False).view(np.uint64)
        k = batch.column("k").to_numpy(zero_copy_only=False)
        for rows in rows_of(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array(k // 8, pa.int32()), pa.array(rows, pa.int32()),
                 pa.array(1 << (k % 8), pa.int32())], names=["part", "row", "mask"])


def decide(model: Model, text: str) -> tuple[str, float]:
    keys = grams(text)
    if not len(keys) or not model.languages:
        return UNKNOWN, 0.0
    counts = np.zeros(len(model.languages))
    where = rows_of(keys)
    for group, table in enumerate(model.slices):
        masks = table[where[0]]
        for rows in where[1:]:
            masks &= table[rows]
        seen = np.bincount(masks, minlength=256)  # by mask; a popcount for each of its bits
        for i in range(group * 8, min(group * 8 + 8, len(counts))):
            counts[i] = seen[_HAS[i % 8]].sum()
    wrong = model.fill ** PROBES
    true = np.clip((counts - len(keys) * wrong) / np.maximum(1 - wrong, 1e-9), 0, None) / len(keys)
    best = int(true.argmax())
    return model.languages[best], float(min(1.0, true[best]))


_HAS = [np.flatnonzero(np.arange(256) >> i & 1) for i in range(8)]


def predict(df: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred",
            score: str = "score", keep: list[str] | None = None) -> DataFrame:
    """df's columns `keep` (default: all), the predicted language and a score from 0 to 1: the share
    of the text's n-grams that the language contains."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch):
        found = [decide(shared.value, t) for t in column_texts(batch, text)]
        return [[x for x, _ in found], [y for _, y in found]]

    return append(df, work, f"`{lang_pred}` string, `{score}` double", keep)
