"""Packing token sequences by patterns that non-negative least squares fits to the length histogram.

The plan is made from the histogram of lengths alone, at most `capacity` numbers, whatever the number
of documents. Lengths are grouped into bins; all patterns of up to three bins that fill a sequence
are enumerated, and non-negative least squares finds how often each should repeat so that the
histogram is used up. Rounded down, the patterns are filled with real lengths: the longest of each
bin, the last document as the longest that still fits. Then room that is left takes the longest
residual that fits, and the rest is packed best fit decreasing, all by counts of equal lengths.

The plan says for each length which rank goes to which sequence and offset. Ranks come from a
numbering within (partition, length) and a running sum of counts per length; no length, however
common, is gathered in a task.

Defined results: NULL and empty texts are the end token alone. A text is never dropped; only longer
ones than the capacity are cut. Rows that share a doc_id are packed each. An empty table gives no
rows. Clashing columns of the input are replaced by those added here.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabq.llm.common import append, checkpoint, column_texts, runs, small_batches

CAPACITY = 2048
END = 0
BIN = 16  # tokens
PARTS = 3  # documents in a pattern that is fitted
CHARS = 1 << 19  # encoded at once


@lru_cache(2)
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of a byte-level BPE file of `tokenizers` without its special tokens. Its ids are
    its ranks, so the ids of ordinary text are those of that library; the rank encoder takes a fifth of
    its time."""
    whole = Tokenizer.from_file(path)
    to_byte = {chr(c): b for b, c in byte_alphabet().items()}
    special = {t.content for t in whole.get_added_tokens_decoder().values() if t.special}
    ranks = {bytes(to_byte[c] for c in token): i for token, i in whole.get_vocab().items()
             if token not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


class Ids:
    """Ids as that library gives them by default: strings of special tokens in a text are their ids, and
    the parts between are encoded each."""

    def __init__(self, path: str):
        tokens = Tokenizer.from_file(path).get_added_tokens_decoder().items()
        self.special = {t.content: i for i, t in tokens}
        self.encode_ordinary = encoder(path).encode_ordinary
        longest = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(longest)})") if longest else None

    def encode(self, text: str) -> list[int]:
        if self.cut is None or not self.cut.search(text):
            return self.encode_ordinary(text)
        ids = []
        for part in self.cut.split(text):
            ids += [self.special[part]] if part in self.special else self.encode_ordinary(part)
        return ids


def byte_alphabet() -> dict[int, int]:
    """The code point by which such files write each byte: itself if printable, else from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of a text's ids and the end token.
    Pieces have `capacity` ids, only the first may have fewer."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    small_batches(docs.sparkSession)

    def run(batches):
        encode = Ids(path).encode
        for batch in batches:
            texts = column_texts(batch, "text")
            for a, b in runs([len(t) for t in texts], CHARS):
                row, columns = [], [[], [], [], [], []]
                for i, text in enumerate(texts[a:b]):
                    ids = np.array([*encode(text), END], "<u4")
                    first = len(ids) % capacity or capacity
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (s, t) in enumerate(zip(edges, edges[1:])):
                        data = ids[s:t].tobytes()
                        row.append(a + i)
                        for column, v in zip(columns, (k, s, t - s, zlib.crc32(data), data)):
                            column.append(v)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                made = [pa.array(c, k) for c, k in zip(columns, kinds)][:4 + with_ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), *made], names)

    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                           + ", ids binary" * with_ids)


# --- the plan, from the histogram ---


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by active sets."""
    n, tolerance = a.shape[1], 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    x, free = np.zeros(n), np.zeros(n, bool)
    for _ in range(3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        if n == 0 or gradient.max() <= tolerance:
            break
        free[int(gradient.argmax())] = True
        while True:
            at = np.flatnonzero(free)
            s = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if len(s) == 0 or s.min() > 0:
                x[:] = 0
                x[at] = s
                break
            low = s <= 0
            step = float((x[at][low] / (x[at][low] - s[low] + 1e-300)).min())
            x[at] += step * (s - x[at])
            free[at[(x[at] <= 1e-12) & low]] = False
            x[~free] = 0
    return x


def patterns(bins: list[int], full: int) -> list[tuple[int, ...]]:
    """Up to PARTS of the bins, falling, that sum to full."""
    def grow(left, most, parts):
        if left == 0:
            yield ()
        elif parts:
            for b in bins:
                if b <= min(left, most) and b * parts >= left:
                    for rest in grow(left - b, b, parts - 1):
                        yield b, *rest
    return list(grow(full, full, PARTS))


class _Stock:
    """Counts of unplaced lengths."""

    def __init__(self, histogram: dict[int, int]):
        self.n = dict(histogram)
        self.lengths = sorted(self.n)

    def longest(self, most: int, least: int = 0) -> int | None:
        at = bisect_right(self.lengths, most) - 1
        return self.lengths[at] if at >= 0 and self.lengths[at] >= least else None

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            del self.lengths[bisect_left(self.lengths, length)]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences), using every length as often as it is."""
    stock, made = _Stock({k: n for k, n in histogram.items() if n}), []
    full = -(-capacity // BIN)
    counts = np.zeros(full + 1)
    for length, n in stock.n.items():
        counts[-(-length // BIN)] += n
    known = patterns([int(b) for b in np.flatnonzero(counts)], full)
    a = np.zeros((full + 1, len(known)))
    for j, p in enumerate(known):
        for b in p:
            a[b, j] += 1
    for p, repeats in sorted(zip(known, nnls(a, counts)), reverse=True):
        left = int(repeats)
        while left > 0:
            chosen, room, usable = [], capacity, True
            for k, b in enumerate(p):
                last = k == len(p) - 1
                length = stock.longest(room if last else min(room, b * BIN),
                                       1 if last else (b - 1) * BIN + 1)
                while length is not None and chosen.count(length) >= stock.n[length]:
                    length = stock.longest(length - 1, 1 if last else (b - 1) * BIN + 1)
                if length is None:
                    usable = False
                    break
                chosen.append(length)
                room -= length
            if not usable:
                break
            n = min([left, *(stock.n[c] // chosen.count(c) for c in chosen)])
            for c in chosen:
                stock.take(c, n)
            left -= n
            made.append((tuple(chosen), n))
    # what stays: best fit decreasing, into the room that patterns left and then new sequences
    rooms: dict[int, list] = {}
    spaces: list[int] = []

    def put(space, entry):
        if space not in rooms:
            rooms[space] = []
            insort(spaces, space)
        rooms[space].append(entry)

    for chosen, n in made:
        put(capacity - sum(chosen), (chosen, n))
    while stock.lengths:
        length = stock.lengths[-1]
        at = bisect_left(spaces, length)
        if at < len(spaces):
            space = spaces[at]
            chosen, n = rooms[space].pop()
            if not rooms[space]:
                del rooms[space], spaces[at]
            each = max(1, min(space // length, stock.n[length] // n))
            used = min(n, stock.n[length])
            if used < n:
                put(space, (chosen, n - used))
        else:
            space, chosen = capacity, ()
            each = max(1, min(capacity // length, stock.n[length]))
            used = stock.n[length] // each
        stock.take(length, used * each)
        put(space - each * length, ((*chosen, *[length] * each), used))
    return [entry for space in spaces for entry in rooms[space]]


def slots(made: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank, first sequence and offset of each run of equal places."""
    found: dict[int, list] = {}
    next_rank: dict[int, int] = {}
    sequence = 0
    for chosen, n in made:
        offset = 0
        for length in chosen:
            rank = next_rank.get(length, 0)
            found.setdefault(length, []).append((rank, sequence, offset))
            next_rank[length] = rank + n
            offset += length
        sequence += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in found.items()}


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (rows with a length up to capacity) with sequence_id and offset."""
    cut = checkpoint(cut.withColumn("__part", F.spark_partition_id()))
    counts = cut.groupBy("__part", "length").agg(F.count("*").alias("__n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(
        F.sum("__n").alias("n")).collect()}  # at most `capacity` rows
    if any(not 0 < k <= capacity for k in histogram):
        raise ValueError("a length is outside 1 to the capacity")
    shared = cut.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    order = [c for c in ("doc_id", "piece") if c in cut.columns] or ["length"]
    own = Window.partitionBy("__part", "length").orderBy(*order)
    ranked = cut.withColumn("__row", F.row_number().over(own) - 1).join(
        starts, ["__part", "length"]).withColumn("__rank", F.col("__row") + F.col("__start"))

    def work(batch):
        lengths = batch.column("length").to_numpy()
        ranks = batch.column("__rank").to_numpy()
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for length in np.unique(lengths):
            rows = lengths == length
            first, base, at = shared.value[int(length)]
            k = np.searchsorted(first, ranks[rows], "right") - 1
            sequence[rows] = base[k] + ranks[rows] - first[k]
            offset[rows] = at[k]
        return [sequence, offset]

    return append(ranked, work, "sequence_id long, offset long",
                  [c for c in cut.columns if c != "__part"])


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each whole sequence; needs pieces made with_ids."""
    parts = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.aggregate(
        "parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids"))
