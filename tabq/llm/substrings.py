"""Removal of repeated passages by relative Lempel-Ziv parsing, exact for windows of WINDOW words.

A window is removed if its words also start earlier: in a smaller doc_id, or earlier in the same text.

Index. Each window's smallest hash of SEED neighbouring words (the leftmost of equal ones) is its seed;
equal windows have the same seed at the same place. A reference is the earliest place of a seed, and
only seeds that occur again are indexed. Reference blocks are the passages around the references of a
text, BLOCK words at most. Factors. Every text is factored against each block that its seeds point to
(no other block can hold WINDOW equal words): seeds that lie alike in text and block make one alignment,
and its longest stretches of equal words are the factors. Those of WINDOW words or more are duplicate
spans, as a reference is earlier. Factor boundaries. A window that holds a seed but is not within its
factor may still equal one of another place. Such windows, and the reference's own at that place, are
compared by hash among themselves. Windows with equal words are either all equal to their reference or
all compared, so nothing is missed.

Spark's part: seeds, passages and boundary windows are shuffled, texts twice (to cut passages out and
to take words out). Blocks come sorted, each before the passages that point to it, and are read as a
stream. Seeds that a bounded sample of texts shows to be frequent are spread over SALTS groups, each
with a reference of its own, whose references are factored against the earliest. Frequent boundary
windows (at most FREQUENT) are sent to all tasks, the others joined.

Defined results: doc_id is read as a whole number; NULL comes before all others and is kept. Rows with
the same doc_id and text are one document and are judged alike; texts that share a doc_id otherwise are
in the order of a hash of the text. NULL and empty texts have no words and the digest of nothing. An
empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabq.llm.common import append, column_bytes, hashes, mix, slices, small_batches, stored

WINDOW = 20  # words
SEED = 6
BLOCK = 512
SAMPLE = 2000  # texts that frequent seeds are looked for in, about
OFTEN = 8  # times that a frequent seed is in them at least
SALTS = 256
SALTED = 4096  # seeds that are spread, at most
FREQUENT = 1 << 16
FIRST_ID = -(1 << 63)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
EDGE = WINDOW - SEED  # words of a window before its seed, at most
CHUNK = 2 << 20  # bytes of text parsed at once


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n neighbouring words, of which only their hashes are given."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        total = total * FACTOR + words[j:len(words) - n + 1 + j]
    return mix(total)


def minimizers(words: np.ndarray) -> np.ndarray:
    """The place of the seed of each window."""
    key = grams(words, SEED)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, place = key[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, EDGE + 1):
        less = key[j:n + j] < least
        least[less] = key[j:n + j][less]
        place[less] = j
    return place + np.arange(n)


def inside(sizes: np.ndarray) -> np.ndarray:
    """Of texts laid end to end: which window starts stay within one text."""
    total = int(sizes.sum())
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(max(0, total - WINDOW + 1))
    return at + WINDOW <= ends[:len(at)]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc and mark name a document; documents are in their order."""
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST_ID)).alias("doc"),
        F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).alias("mark"),
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def _split(batch: pa.RecordBatch) -> tuple[list[list[bytes]], np.ndarray]:
    words = [t.split() for t in column_bytes(batch, "text")]
    return words, np.array([len(w) for w in words], np.int64)


def seeds(rows: DataFrame) -> DataFrame:
    """seed, doc and place (mark and word number in one number, in their order) of every seed."""
    def run(batches):
        for batch in (p for b in batches for p in slices(b, CHUNK)):
            words, sizes = _split(batch)
            flat = hashes([w for own in words for w in own])
            found = minimizers(flat)[inside(sizes)]
            at = np.unique(found)
            text = np.searchsorted(np.cumsum(sizes), at, "right")
            place = (batch.column("mark").to_numpy()[text] << 32) + at - (np.cumsum(sizes) - sizes)[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams(flat, SEED)[at].view(np.int64) if len(at) else at),
                 batch.column("doc").take(pa.array(text)), pa.array(place)], ["seed", "doc", "place"])

    return rows.select("doc", "mark", "text").mapInArrow(run, "seed long, doc long, place long")


def references(rows: DataFrame) -> DataFrame:
    """doc, place and the ref_doc and ref_place that a seed points to, for all seeds that were met."""
    found = seeds(rows)
    every = max(1, rows.count() // SAMPLE)
    sample = rows.where(F.pmod(F.xxhash64("doc", "mark"), F.lit(every)) == 0)
    frequent = seeds(sample).groupBy("seed").agg(F.count("*").alias("often")).where(
        F.col("often") >= OFTEN).orderBy(F.desc("often"), "seed").limit(SALTED).select("seed").collect()
    known = F.broadcast(rows.sparkSession.createDataFrame(
        [(r.seed, True) for r in frequent], "seed long, spread boolean"))  # SALTED rows at most
    spread = F.pmod(F.xxhash64("doc", F.shiftright("place", 32)), F.lit(SALTS)).cast("int")
    found = found.join(known, "seed", "left").withColumn("salt", F.when(F.col("spread"), spread).otherwise(-1))

    def first(by):
        order = Window.partitionBy(*by).orderBy("doc", "place")
        return F.first(F.struct("doc", "place")).over(order)

    near = found.withColumn("first", first(["seed", "salt"]))
    is_first = (F.col("first.doc") == F.col("doc")) & (F.col("first.place") == F.col("place"))
    # of frequent seeds, the references of the groups point on to the earliest; SALTS rows a seed
    heads = found.where("salt >= 0").groupBy("seed", "salt").agg(
        F.min(F.struct("doc", "place")).alias("head")).select("seed", "head.doc", "head.place")
    heads = heads.withColumn("first", first(["seed"]))
    return near.where(~is_first).select("doc", "place", "first").union(
        heads.where(~is_first).select("doc", "place", "first")).select(
        "doc", "place", F.col("first.doc").alias("ref_doc"), F.col("first.place").alias("ref_place"))


def passages(rows: DataFrame, pointers: DataFrame) -> DataFrame:
    """Reference blocks, and the alignments of texts with them, as words."""
    mark = F.shiftright("place", 32)
    word = F.col("place").bitwiseAND(F.lit(0xFFFFFFFF))
    none = F.lit(None).cast("long")
    own = pointers.select("doc", mark.alias("mark"), F.struct(
        word.alias("at"), F.col("ref_doc"), F.col("ref_place")).alias("seed"))
    referred = pointers.select(F.col("ref_doc").alias("doc"), F.col("ref_place").alias("place")).distinct()
    referred = referred.select("doc", mark.alias("mark"), F.struct(
        word.alias("at"), none.alias("ref_doc"), none.alias("ref_place")).alias("seed"))
    lists = own.union(referred).groupBy("doc", "mark").agg(F.collect_list("seed").alias("seeds"))
    lists = lists.withColumnsRenamed({"doc": "of_doc", "mark": "of_mark"})
    joined = rows.join(lists, (F.col("doc") == F.col("of_doc")) & (F.col("mark") == F.col("of_mark")))

    def run(batches):
        for batch in (p for b in batches for p in slices(b, CHUNK)):
            words, sizes = _split(batch)
            listed = batch.column("seeds")
            each = np.diff(listed.offsets.to_numpy())
            flat = listed.flatten()
            row = np.repeat(np.arange(batch.num_rows), each)
            at = flat.field("at").to_numpy()
            is_ref = flat.field("ref_doc").is_null().to_numpy(zero_copy_only=False)
            doc, own_mark = (batch.column(c).to_numpy()[row] for c in ("doc", "mark"))
            ref_doc = np.where(is_ref, doc, flat.field("ref_doc").fill_null(0).to_numpy())
            place = flat.field("ref_place").fill_null(0).to_numpy()
            ref_mark = np.where(is_ref, own_mark, place >> 32)
            ref_at = np.where(is_ref, at, place & 0xFFFFFFFF)
            block, shift = ref_at // BLOCK, at - ref_at
            order = np.lexsort((at, shift, block, ref_mark, ref_doc, is_ref, row))
            keys = [x[order] for x in (row, is_ref, ref_doc, ref_mark, block, shift)]
            at, ref_at = at[order], ref_at[order]
            new = np.ones(len(order), bool)
            if len(order):
                gap = np.diff(at) > 2 * WINDOW
                new[1:] = (gap & ~keys[1][1:]) | np.any([np.diff(k) != 0 for k in keys], axis=0)
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(order)) if len(starts) else starts
            low = np.maximum(at[starts] - EDGE, 0)
            high = np.minimum(at[ends - 1] + WINDOW, sizes[keys[0][starts]])
            cut = [b" ".join(words[r][s:t]) for r, s, t in
                   zip(keys[0][starts].tolist(), low.tolist(), high.tolist())]
            offsets = np.append(starts, len(order)).astype(np.int32)
            seed_at = pa.ListArray.from_arrays(pa.array(offsets), pa.array(at.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[2][starts]), pa.array(keys[3][starts]), pa.array(keys[4][starts]),
                 pa.array(~keys[1][starts]), pa.array(low - keys[5][starts]),
                 pa.array(doc[order][starts]), pa.array(own_mark[order][starts]), pa.array(low),
                 seed_at, pa.array(cut, pa.binary())],
                ["ref_doc", "ref_mark", "block", "is_text", "ref_at", "doc", "mark", "at", "seeds", "words"])

    return joined.select("doc", "mark", "text", "seeds").mapInArrow(
        run, "ref_doc long, ref_mark long, block long, is_text boolean, ref_at long, doc long, mark long, "
             "at long, seeds array<int>, words binary")


def factor(text: np.ndarray, other: np.ndarray, held: np.ndarray, sizes: np.ndarray, seeds_at: np.ndarray):
    """Alignments laid end to end, `sizes` words each: word hashes of the text and of the block, and
    where the block has a word. Returns the start and length of factors of WINDOW words or more, and the
    starts of windows whose seed is given but that are not in its factor."""
    equal = (text == other) & held
    bounds = np.cumsum(sizes)
    edge = np.zeros(len(text) + 1, bool)
    edge[0], edge[bounds] = True, True
    edge[1:-1] |= equal[1:] != equal[:-1]
    at = np.flatnonzero(edge)
    start, length = at[:-1], np.diff(at)
    long = equal[start] & (length >= WINDOW) if len(start) else np.zeros(0, bool)
    covered = np.concatenate(([0], np.cumsum(equal)))
    whole = inside(sizes)
    is_seed = np.zeros(len(text), bool)
    is_seed[seeds_at] = True
    n = len(whole)
    open_ = whole & (covered[WINDOW:WINDOW + n] - covered[:n] < WINDOW)
    if open_.any():
        open_ &= is_seed[minimizers(text)]
    return start[long], length[long], np.flatnonzero(open_)


def parse(cut: DataFrame) -> DataFrame:
    """is_span, key, doc, place, length: factors, and the windows at their boundaries with a hash."""
    names = ["is_span", "key", "doc", "place", "length"]
    fields = "is_span boolean, key long, doc long, place long, length long"

    def run(batches):
        key, block, begin = None, np.zeros(0, np.uint64), 0
        for batch in (p for b in batches for p in slices(b, CHUNK)):
            columns = [batch.column(c).to_pylist() for c in ("ref_doc", "ref_mark", "block", "is_text",
                                                            "ref_at", "words")]
            rows, texts, others = [], [], []
            for i, (ref_doc, ref_mark, number, is_text, ref_at, words) in enumerate(zip(*columns)):
                own = hashes(words.split())
                if not is_text:  # a block comes before the texts that point to it
                    key, block, begin = (ref_doc, ref_mark, number), own, ref_at
                    continue
                held = block if key == (ref_doc, ref_mark, number) else block[:0]
                low = ref_at - begin  # the place in the block that the text's first word lies on
                a, b = max(0, -low), max(0, min(len(own), len(held) - low))
                aligned, is_held = np.zeros(len(own), np.uint64), np.zeros(len(own), bool)
                if a < b:
                    aligned[a:b], is_held[a:b] = held[low + a:low + b], True
                rows.append(i)
                texts.append(own)
                others.append((aligned, is_held))
            if not rows:
                continue
            sizes = np.array([len(t) for t in texts], np.int64)
            first = np.cumsum(sizes) - sizes
            text = np.concatenate(texts)
            other, held = (np.concatenate([o[k] for o in others]) for k in (0, 1))
            some = batch.take(pa.array(rows))
            each = np.diff(some.column("seeds").offsets.to_numpy())
            at = some.column("at").to_numpy()
            seeds_at = some.column("seeds").flatten().to_numpy() + np.repeat(first - at, each)
            start, length, open_ = factor(text, other, held, sizes, seeds_at)
            doc, mark, ref_doc, ref_mark, ref_at = (
                some.column(c).to_numpy() for c in ("doc", "mark", "ref_doc", "ref_mark", "ref_at"))

            def place(of, own_mark, own_at, where):
                return (own_mark[of] << 32) + own_at[of] + where - first[of]

            of = np.searchsorted(np.cumsum(sizes), start, "right")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(start), bool)), pa.array(np.zeros(len(start), np.int64)),
                 pa.array(doc[of]), pa.array(place(of, mark, at, start)), pa.array(length)], names)
            if not len(open_):
                continue
            of = np.searchsorted(np.cumsum(sizes), open_, "right")
            yield _open(names, grams(text, WINDOW)[open_], doc[of], place(of, mark, at, open_))
            covered = np.concatenate(([0], np.cumsum(held)))
            full = covered[open_ + WINDOW] - covered[open_] == WINDOW  # the block has such a window
            open_, of = open_[full], of[full]
            yield _open(names, grams(other, WINDOW)[open_], ref_doc[of],
                        place(of, ref_mark, ref_at, open_))

    keys = ["ref_doc", "ref_mark", "block"]
    return cut.repartition(*keys).sortWithinPartitions(*keys, "is_text").mapInArrow(run, fields)


def _open(names, key, doc, place):
    n = len(key)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, bool)), pa.array(key.view(np.int64)), pa.array(doc), pa.array(place),
         pa.array(np.full(n, WINDOW))], names)


def repeated_windows(windows: DataFrame) -> DataFrame:
    """doc, place and length of the windows (key, doc, place, length) that are not their key's first."""
    spot = F.struct("doc", "place")
    firsts = windows.groupBy("key").agg(F.min(spot).alias("first"), F.max(spot).alias("last"),
                                        F.count("*").alias("n")).where("first != last")
    firsts = stored(firsts.drop("last"))
    total = firsts.agg(F.sum("n")).first()[0] or 0
    is_frequent = F.col("n") * F.lit(FREQUENT) >= F.lit(total)
    frequent = F.broadcast(firsts.where(is_frequent).drop("n"))  # FREQUENT rows at most
    rare = firsts.where(~is_frequent).drop("n")
    others = windows.join(frequent.select("key"), "key", "left_anti")
    found = windows.join(frequent, "key").unionByName(others.join(rare, "key"))
    return found.where((F.col("first.doc") != F.col("doc")) | (F.col("first.place") != F.col("place"))
                       ).select("doc", "place", "length")


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, mark, start and length (in words) of passages that start earlier too; they may overlap."""
    small_batches(docs.sparkSession)
    rows = _keyed(docs, doc_id, text)
    parsed = stored(parse(passages(rows, stored(references(rows)))))
    found = parsed.where("is_span").select("doc", "place", "length").unionByName(
        repeated_windows(parsed.where("NOT is_span").drop("is_span")))
    return found.select("doc", F.shiftright("place", 32).alias("mark"),
                        F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("start"), "length")


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", kept: str | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row, and the kept words as the column `kept`."""
    found = spans(docs, doc_id, text).groupBy("doc", "mark").agg(
        F.collect_list(F.struct("start", "length")).alias("spans"))
    found = found.withColumnsRenamed({"doc": "of_doc", "mark": "of_mark"})
    rows = _keyed(docs, doc_id, text)
    joined = rows.join(found, (F.col("doc") == F.col("of_doc")) & (F.col("mark") == F.col("of_mark")), "left")

    def work(batch):
        listed = batch.column("spans")
        made = [[], [], [], []]
        for own, spans_ in zip(column_bytes(batch, "text"), listed):
            words = own.split()
            n = len(words)
            if spans_.is_valid:
                flat = spans_.values
                start = flat.field("start").to_numpy()
                depth = np.zeros(n + 1, np.int64)
                np.add.at(depth, start, 1)
                np.add.at(depth, start + flat.field("length").to_numpy(), -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:n] == 0).tolist()]
            left = b" ".join(words)
            for column, v in zip(made, (n, n - len(words), hashlib.sha256(left).hexdigest(),
                                        left.decode("utf-8"))):
                column.append(v)
        return made if kept else made[:3]

    fields = "n_words long, n_removed long, kept_sha256 string" + (f", `{kept}` string" if kept else "")
    return append(joined.select("doc_id", "text", "spans"), work, fields, ["doc_id"])
