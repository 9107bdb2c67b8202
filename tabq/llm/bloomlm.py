"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

A count c is kept as its octave 1 + floor(log2 c) and the part of the octave it lies in: an n-gram
enters the filter with each octave up to its own, then with each part up to its own, and a reader
probes step after step until one is missing. A part stands for the middle of its counts; it is one
count wide up to PARTS counts. The filter holds the words and the pairs of neighbours of the training
texts. A pair's probability is smoothed towards the word's:

    p(w | h) = (c(h w) + M p(w)) / (c(h) + M + E),   p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))

E is the mass that the filter's false positives add to a known history: a pair that never occurred is
found once with the rate f of the filter, hence f V in all. So the probabilities after a history sum
to one. The number of probes grows with log2 V, which keeps E below M.

The filter has BITS bits for each training token and probe, in segments that are built where the n-grams
of a segment meet; so it grows with the corpus, and each task holds one segment. All n-grams enter, at
every size. Up to MOST_BYTES the filter is broadcast, which puts it on the disks of the driver and of every
executor. A larger one is never put together: the distinct n-grams of each chunk of texts go once, with
their training counts, to the segments they fall in, which are built, probed for them and dropped; their
levels come back to the chunk. Both ways give the same scores. Segments that are neighbours are built by
one task, up to BLOCK of them, so that what a chunk sends to a task stays worth packing.

The base score needs exact counts. Words whose count is at least tokens / HEAVY, which are at most
HEAVY, are broadcast; the others meet their counts in a join, where none of them can be hot.

Defined results: NULL and empty texts have the end token only. With no training text N and V are 0.
Rows that share a doc_id get a row each, an empty table none. Other columns are not read.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabq.llm.common import (
    bucketed, column_bytes, folded_words, hashes, mix, numbered, runs, small_batches, stored)

BITS = 1.45
FEWEST_PROBES = 4
SEGMENT = 1 << 22  # bits
MOST_BYTES = 32 << 20
BLOCK = 32  # segments, at most
HEAVY = 1 << 22
PRIOR = 2000.0  # M
OCTAVES = 40
PARTS = {1: 32, 2: 4}  # of an octave, at most; by order. Sums over many pairs need no finer ones
CHUNK = 6 << 20  # bytes of text worked on at once
RUN = 1 << 15  # n-grams that are probed together
REMEMBERED = 1 << 18  # n-grams of each order
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_STEP = np.uint64(0x9FB21C651E98DF25)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and the number of each text's tokens."""
    words = [folded_words(t) for t in texts]
    sizes = np.array([len(w) + 1 for w in words])
    all_ = np.full(int(sizes.sum()), END)
    ends = np.cumsum(sizes)
    inside = np.ones(len(all_), bool)
    inside[ends - 1] = False
    all_[inside] = hashes([w for each in words for w in each])
    return all_, sizes


def histories(all_: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.concatenate((all_[:1], all_[:-1]))
    before[np.cumsum(sizes) - sizes] = START
    return before


def word_keys(h: np.ndarray) -> np.ndarray:
    return mix(h, 1)


def pair_keys(before: np.ndarray, h: np.ndarray) -> np.ndarray:
    return mix(before * _STEP + h, 2)


def _chunks(batch):
    texts = column_bytes(batch, "text")
    for a, b in runs([len(t) for t in texts], CHUNK):
        yield a, b, texts[a:b]


# --- counting ---


def _words(batches):
    """(hash, training count, count) of each chunk's tokens."""
    for batch in batches:
        train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
        for a, b, texts in _chunks(batch):
            all_, sizes = tokens(texts)
            keys, at = np.unique(all_, return_inverse=True)
            known = np.bincount(at, np.repeat(train[a:b], sizes), len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(known.astype(np.int64)),
                 pa.array(np.bincount(at, minlength=len(keys)))], names=["h", "c", "total"])


def _grouped(groups):
    """Each chunk's words and pairs with counts, as one row for each group of n-grams."""
    def run(batches):
        for batch in batches:
            for _, _, texts in _chunks(batch):
                all_, sizes = tokens(texts)
                before = histories(all_, sizes)
                starts = np.full(len(texts), START)
                for order, keys in ((1, word_keys(np.concatenate((all_, starts)))),
                                    (2, pair_keys(before, all_))):
                    keys, n = np.unique(keys, return_counts=True)
                    group = (keys % np.uint64(groups)).astype(np.int64)
                    place = np.argsort(group, kind="stable")
                    keys, n, group = short_keys(keys[place], order), n[place], group[place]
                    edges = np.flatnonzero(np.diff(group, prepend=-1, append=groups))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(group[edges[:-1]].astype(np.int32)),
                         pa.array(np.full(len(edges) - 1, order, np.int32)),
                         pa.array([keys[s:e].tobytes() for s, e in zip(edges, edges[1:])], pa.binary()),
                         pa.array([n[s:e].astype("<u4").tobytes() for s, e in zip(edges, edges[1:])],
                                  pa.binary())], names=["grp", "ord", "keys", "counts"])
    return run


def short_keys(keys: np.ndarray, order: int) -> np.ndarray:
    """What names an n-gram within its group."""
    return (keys >> np.uint64(32)).astype(np.uint32) ^ np.uint32(order)


def mixed_keys(short: np.ndarray, order: int, step) -> np.ndarray:
    """Keys of the n-grams with a step, or one each."""
    return mix(short.astype(np.uint64) | np.asarray(step).astype(np.uint64) << np.uint64(32), order)


def places(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first probe's place in the n-gram's segment and the step to the next, both modulo SEGMENT.
    They may be added up beyond 32 bits: SEGMENT divides what is lost."""
    return mixed.astype(np.uint32), (mixed >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def parts_of(octave: np.ndarray, order: int) -> np.ndarray:
    """How many parts an octave has: as many as it has counts, up to PARTS."""
    return np.minimum(1 << np.maximum(octave - 1, 0), PARTS[order])


def codes(n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The octaves of counts (at least 1) and the parts they lie in."""
    octave = np.minimum(np.frexp(n)[1].astype(np.int64), OCTAVES - 1)
    low = 1 << (octave - 1)
    parts = parts_of(octave, order)
    return octave, np.minimum((n.astype(np.int64) - low) * parts // low, parts - 1)


def values(order: int) -> np.ndarray:
    """What each code (octave * PARTS + part) stands for: the middle of its counts, 0 for none."""
    octave, part = np.divmod(np.arange(OCTAVES * PARTS[order]), PARTS[order])
    low = 1 << np.maximum(octave - 1, 0)
    width = low // parts_of(octave, order)
    return np.where(octave > 0, low + part * width + (width - 1) / 2, 0.0)


def _enter(bits: np.ndarray, keys: np.ndarray, n: np.ndarray, order: int, probes: int) -> None:
    """Enter a segment's distinct n-grams, which occur n times."""
    def enter(keys, step):
        at, next_ = places(mixed_keys(keys, order, step))
        for _ in range(probes):
            bits[at & (SEGMENT - 1)] = True
            at += next_

    octave, part = codes(n, order)
    for j in range(1, int(octave.max(initial=0)) + 1):
        enter(keys[octave >= j], j * PARTS[order])
    for k in range(1, int(part.max(initial=0)) + 1):
        far = part >= k
        enter(keys[far], octave[far] * PARTS[order] + k)


def _segment(probes: int):
    """A segment's bits and its share of false positives."""
    def run(key, table):
        bits = np.zeros(SEGMENT, bool)
        for order in (1, 2):
            own = table.filter(pc.equal(table.column("ord"), order))
            all_ = np.frombuffer(b"".join(own.column("keys").to_pylist()), "<u4")
            n = np.frombuffer(b"".join(own.column("counts").to_pylist()), "<u4")
            keys, at = np.unique(all_, return_inverse=True)
            _enter(bits, keys, np.bincount(at, n, len(keys)), order, probes)
        return pa.table({"grp": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
                         "rate": pa.array([bits.mean() ** probes])})
    return run


# --- the model ---


def probe(flat: np.ndarray, base: np.ndarray, short: np.ndarray, order: int, probes: int) -> np.ndarray:
    """Probe step after step, octaves first; the code of the last one found, 0 if none. base: the first
    byte of each segment. n-grams of a segment are best side by side, as they are worked on in runs
    that stay in the processor's cache with what they read."""
    code = np.empty(len(short), np.int64)
    for a in range(0, len(short), RUN):
        code[a:a + RUN] = _probe(flat, base[a:a + RUN], short[a:a + RUN], order, probes)
    return code


def _probe(flat: np.ndarray, base: np.ndarray, short: np.ndarray, order: int, probes: int) -> np.ndarray:
    def found(left, step):
        at, next_ = places(mixed_keys(short.take(left), order, step))
        first, all_hit = base.take(left), np.ones(len(left), np.uint8)
        for _ in range(probes):
            byte = flat.take(first + ((at & np.uint32(SEGMENT - 1)) >> np.uint32(3)))
            byte >>= at.astype(np.uint8) & np.uint8(7)
            all_hit &= byte
            at += next_
            hits = np.count_nonzero(all_hit.view(bool))
            if not hits:
                break
            if 4 * hits < 3 * len(left):  # go on without those that are missing
                hit = np.flatnonzero(all_hit)
                left, at, next_, first, all_hit = (x.take(hit) for x in (left, at, next_, first, all_hit))
        return left[all_hit.view(bool)]

    parts = PARTS[order]
    code, left = np.zeros(len(short), np.int64), np.arange(len(short))
    for j in range(1, OCTAVES):
        left = found(left, j * parts)
        if not len(left):
            break
        code[left] = j * parts
    left = np.flatnonzero(code)
    for k in range(1, parts):
        left = left[parts_of(code[left] // parts, order) > k]
        if not len(left):
            break
        left = found(left, code[left] + 1)
        code[left] += 1
    return code


@dataclass
class Smoothing:
    n: int
    v: int
    rate: float  # of false positives

    def log10(self, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """log10 p of each token. words: codes of the tokens, then of their histories."""
        count = values(1)[words]
        own, history = count[:len(pairs)], count[len(pairs):]
        pair = np.minimum(values(2)[pairs], history)
        word = (own + 0.5) / (self.n + 0.5 * (self.v + 1))
        false = np.where(history > 0, self.rate * self.v, 0.0)
        return np.log10((np.minimum(pair, own) + PRIOR * word) / (history + PRIOR + false))


@dataclass
class Model(Smoothing):
    probes: int
    segments: np.ndarray  # (number, SEGMENT / 8)
    remembered: dict = field(default_factory=dict)  # by order: n-grams, sorted, and their codes

    def levels(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Codes of distinct n-grams, in order. Those found often are remembered from chunk to chunk."""
        known, own = self.remembered.get(order, (keys[:0], np.empty(0, np.uint16)))
        at = np.searchsorted(known, keys)
        new = np.ones(len(keys), bool)
        if len(known):
            new = known[np.minimum(at, len(known) - 1)] != keys
        code = np.empty(len(keys), np.int64)
        code[~new] = own[at[~new]]
        asked, at = keys[new], at[new]
        segment, place = _by_segment(asked, len(self.segments))
        found = np.empty(len(asked), np.int64)
        found[place] = probe(self.segments.reshape(-1), segment[place] * (SEGMENT // 8),
                             short_keys(asked[place], order), order, self.probes)
        code[new] = found
        often = np.flatnonzero(found >= order * PARTS[order])[:max(0, REMEMBERED - len(known))]
        if len(often):
            self.remembered[order] = (np.insert(known, at[often], asked[often]),
                                      np.insert(own, at[often], found[often].astype(np.uint16)))
        return code

    def log10(self, all_: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 p of each token."""
        grams = (_grams(all_, sizes, order) for order in (1, 2))
        return super().log10(*(self.levels(keys, k + 1)[at] for k, (keys, at) in enumerate(grams)))


def probes_of(v: int) -> int:
    """Probes by which the false positives after a history, of v words, weigh less than PRIOR."""
    return max(FEWEST_PROBES, math.ceil(math.log2(max(1, 2 * v / PRIOR))))


def segments_of(n: int, probes: int = FEWEST_PROBES) -> int:
    """How many segments the filter of n training tokens has."""
    return max(1, math.ceil(n * BITS * probes / SEGMENT))


def build(train: DataFrame, segments: int, probes: int, text: str = "text") -> DataFrame:
    """grp, bits and rate of each segment of the filter of all training texts."""
    return train.select(F.col(text).alias("text")).mapInArrow(
        _grouped(segments), "grp int, ord int, keys binary, counts binary").groupBy(
        "grp").applyInArrow(_segment(probes), "grp int, bits binary, rate double")


def learn(train: DataFrame, n: int, v: int, text: str = "text") -> Model:
    """The filter of all training texts, of n tokens. It comes to the driver whole; `score` uses this
    up to MOST_BYTES."""
    probes = probes_of(v)
    segments, rate = segments_of(n, probes), 0.0
    bits = np.zeros((segments, SEGMENT // 8), np.uint8)
    for row in build(train, segments, probes, text).toLocalIterator():
        bits[row.grp] = np.frombuffer(row.bits, np.uint8)
        rate += row.rate / segments
    return Model(n, v, rate, probes, bits)


# --- scoring ---


def _known(heavy, all_: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    """Of each text the tokens that are broadcast and known, and their part of the base score."""
    words, counts = heavy
    at, found = _look_up(words, all_)
    c = np.where(found, counts[at], 0)
    base = np.where(found, np.log10(c + 0.5), 0.0)
    return [pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
            pa.array(np.add.reduceat(base, first))]


SCORED = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score"]


def _scores(shared, heavy):
    def run(batches):
        model = shared.value
        for batch in batches:
            for a, b, texts in _chunks(batch):
                all_, sizes = tokens(texts)
                first = np.cumsum(sizes) - sizes
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [own.column("row"), own.column("doc_id"), own.column("held_out"),
                     pa.array(sizes), *_known(heavy.value, all_, first),
                     pa.array(np.add.reduceat(model.log10(all_, sizes), first))], SCORED)
    return run


def _look_up(words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(words):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(words, keys), len(words) - 1)
    return at, words[at] == keys


def _rest(heavy, rows: np.ndarray, all_: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """(row, hash, count) of the words that are not broadcast."""
    doc = np.repeat(np.arange(len(rows)), sizes)
    rest = ~_look_up(heavy[0], all_)[1]
    all_, doc = all_[rest], doc[rest]
    order = np.lexsort((all_, doc))
    all_, doc = all_[order], doc[order]
    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0)
                         | (np.diff(all_, prepend=np.uint64(0)) != 0))
    n = np.diff(new, append=len(all_))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[doc[new]]), pa.array(all_[new].view(np.int64)),
         pa.array(n.astype(np.int32))], names=["row", "h", "k"])


def _light(heavy):
    def run(batches):
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for a, b, texts in _chunks(batch):
                yield _rest(heavy.value, rows[a:b], *tokens(texts))
    return run


# --- scoring by a filter that is not broadcast ---


def packed(x: np.ndarray) -> bytes:
    """Small numbers, compressed: first all lowest bytes, then the next ones."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<IB", len(x), width) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<IB", data)
    planes = np.frombuffer(pa.decompress(data[5:], n * width, codec="zstd"), np.uint8)
    x = np.zeros((n, 8), np.uint8)
    x[:, :width] = planes.reshape(width, n).T
    return x.view("<u8")[:, 0].astype(np.int64)


def packed_sorted(x: np.ndarray) -> bytes:
    """Sorted numbers in about log2(range / number) + 2 bits each: of each its low bits, and a bit row
    with a mark for each number, as far on as its high bits say."""
    n, low = len(x), max(0, int(x[-1]).bit_length() - len(x).bit_length()) if len(x) else 0
    marks = np.zeros(int(x[-1] >> np.uint64(low)) + n if n else 0, bool)
    marks[(x >> np.uint64(low)).astype(np.int64) + np.arange(n)] = True
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, count=low,
                         bitorder="little") if low else np.empty(0, np.uint8)
    return (struct.pack("<IB", n, low) + np.packbits(bits, bitorder="little").tobytes()
            + np.packbits(marks, bitorder="little").tobytes())


def unpacked_sorted(data: bytes) -> np.ndarray:
    n, low = struct.unpack_from("<IB", data)
    edge = 5 + -(-n * low // 8)
    bits = np.zeros((n, 64), np.uint8)
    bits[:, :low] = np.unpackbits(np.frombuffer(data[5:edge], np.uint8), count=n * low,
                                  bitorder="little").reshape(n, low)
    marks = np.unpackbits(np.frombuffer(data[edge:], np.uint8), bitorder="little")
    high = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0] | high << np.uint64(low)


def _stored_chunks(batches):
    """Each chunk of texts as one row: its texts' columns as lists, its distinct words, those of an
    octave of counts together and the frequent ones first, and which word each token is."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        for a, b, texts in _chunks(batch):
            all_, sizes = tokens(texts)
            words, at, n = np.unique(all_, return_inverse=True, return_counts=True)
            octave = np.frexp(n)[1]
            order = np.argsort(-octave, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            edges = np.append(np.flatnonzero(np.diff(octave[order], prepend=-1)), len(order))
            own = [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), x) for x in (
                *(batch.column(c).slice(a, b - a) for c in ("row", "doc_id", "held_out")),
                pa.array(sizes.astype(np.int64)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), *own,
                 pa.array([[packed_sorted(words[order[s:e]]) for s, e in zip(edges, edges[1:])]],
                          pa.list_(pa.binary())),
                 pa.array([packed(rank[at])], pa.binary())],
                names=["chunk", "row", "doc_id", "held_out", "sizes", "words", "at"])
            number += 1


def _tokens_of(batch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the i-th chunk and the number of each text's."""
    words = np.concatenate([unpacked_sorted(x) for x in batch.column("words")[i].as_py()])
    return (words[unpacked(batch.column("at")[i].as_py())],
            np.array(batch.column("sizes")[i].as_py(), np.int64))


def _grams(all_: np.ndarray, sizes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """A chunk's distinct n-grams, and which are its tokens (of words: then their histories)."""
    if order == 2:
        return np.unique(pair_keys(histories(all_, sizes), all_), return_inverse=True)
    keys, own = np.unique(word_keys(np.append(all_, START)), return_inverse=True)
    before = np.concatenate((own[:1], own[:-2]))
    before[np.cumsum(sizes) - sizes] = own[-1]
    return keys, np.concatenate((own[:-1], before))


def _by_segment(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram's segment, and the order in which they go to the segments."""
    segment = (keys % np.uint64(segments)).astype(np.int64)
    short = segment.astype(np.uint16) if segments <= 1 << 16 else segment  # sorted faster
    return segment, np.argsort(short, kind="stable")


def _sent(segments: int, block: int, places: int):
    """The distinct n-grams of each chunk and their training counts, as one row for each order and block
    of segments. They go to the chunk's own place, which answers; those of training texts to all."""
    def run(batches):
        for batch in batches:
            for i, chunk in enumerate(batch.column("chunk").to_pylist()):
                all_, sizes = _tokens_of(batch, i)
                train = ~np.array(batch.column("held_out")[i].as_py(), bool)
                home = int(mix(np.array([chunk], np.uint64))[0] % np.uint64(places))
                for order in (1, 2):
                    keys, at = _grams(all_, sizes, order)
                    n = np.bincount(at[:len(all_)], np.repeat(train, sizes), len(keys)).astype(np.int64)
                    if order == 1:
                        n[at[len(all_)]] += np.count_nonzero(train)  # the first history is START
                    segment, to = _by_segment(keys, segments)
                    yield _sent_rows(chunk, home, True, order, keys[to], segment[to], n[to], block)
                    to = to[n[to] > 0]
                    for place in range(places):
                        if place != home and len(to):
                            yield _sent_rows(chunk, place, False, order, keys[to], segment[to], n[to], block)
    return run


def _sent_rows(chunk: int, place: int, asks: bool, order: int, keys: np.ndarray, segment: np.ndarray,
               n: np.ndarray, block: int) -> pa.RecordBatch:
    grp, inner = np.divmod(segment, block)
    short = inner.astype(np.uint64) << np.uint64(32) | keys >> np.uint64(32)
    edges = np.append(np.flatnonzero(np.diff(grp, prepend=-1)), len(grp))
    rows = list(zip(edges, edges[1:]))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(rows), chunk)), pa.array(grp[edges[:-1]].astype(np.int32)),
         pa.array(np.full(len(rows), place)), pa.array(np.full(len(rows), asks)),
         pa.array(np.full(len(rows), order, np.int32)),
         pa.array([packed_sorted(short[s:e]) for s, e in rows], pa.binary()),
         pa.array([packed(n[s:e]) for s, e in rows], pa.binary())],
        names=["chunk", "grp", "place", "asks", "ord", "keys", "counts"])


def _answered(block: int, probes: int):
    """Build a block's segments one by one and look up the n-grams that chunks ask for. One more row
    has the segments' shares of false positives, added up."""
    def run(key, table):
        grp, place = (k.as_py() for k in key)
        own = {order: _Sent(table.filter(pc.equal(table.column("ord"), order)), order, block)
               for order in (1, 2)}
        rate = 0.0
        for s in range(block):
            bits, grams = np.zeros(SEGMENT, bool), {}
            for order, sent in own.items():
                at = sent.by_segment[sent.edges[s]:sent.edges[s + 1]]
                keys, which = np.unique(sent.short[at], return_inverse=True)
                n = np.bincount(which, sent.n[at], len(keys))
                _enter(bits, keys[n > 0], n[n > 0], order, probes)
                grams[order] = at, keys, which
            rate += bits.mean() ** probes
            flat = np.packbits(bits, bitorder="little")
            for order, (at, keys, which) in grams.items():
                code = probe(flat, np.zeros(len(keys), np.int64), keys, order, probes)
                own[order].levels[at] = code[which]
        rates = pa.table({"chunk": pa.array([None], pa.int64()), "grp": pa.array([grp], pa.int32()),
                          "ord": pa.array([0], pa.int32()), "levels": pa.array([None], pa.binary()),
                          "rate": pa.array([rate if place == 0 else 0.0])})
        return pa.concat_tables([rates, *(sent.answers() for sent in own.values())])
    return run


class _Sent:
    """The n-grams of an order that are sent to a block, and their levels."""

    def __init__(self, rows: pa.Table, order: int, block: int):
        self.rows = rows
        keys = [unpacked_sorted(x) for x in rows.column("keys").to_pylist()]
        self.ends = np.cumsum([0, *map(len, keys)])
        keys = np.concatenate([np.empty(0, np.uint64), *keys])
        self.short = short_keys(keys << np.uint64(32), order)
        self.n = np.concatenate([np.empty(0, np.uint32), *(
            unpacked(x).astype(np.uint32) for x in rows.column("counts").to_pylist())])
        segment = (keys >> np.uint64(32)).astype(np.uint8)
        self.by_segment = np.argsort(segment, kind="stable")
        self.edges = np.cumsum([0, *np.bincount(segment, minlength=block)])
        self.levels = np.empty(len(keys), np.uint16)

    def answers(self) -> pa.Table:
        levels = [packed(self.levels[s:e]) if asks else None for s, e, asks in zip(
            self.ends, self.ends[1:], self.rows.column("asks").to_pylist())]
        return self.rows.select(["chunk", "grp", "ord"]).append_column(
            "levels", pa.array(levels, pa.binary())).append_column(
            "rate", pa.nulls(len(levels), pa.float64())).filter(self.rows.column("asks"))


def _chunk_scores(smoothing: Smoothing, segments: int, heavy):
    """A chunk's rows, as `_scores` makes them, from the levels that came back."""
    def run(key, chunk, answers):
        all_, sizes = _tokens_of(chunk, 0)
        levels = []
        for order in (1, 2):
            keys, at = _grams(all_, sizes, order)
            own = answers.filter(pc.equal(answers.column("ord"), order)).sort_by("grp")
            found = np.empty(len(keys), np.int64)
            found[_by_segment(keys, segments)[1]] = np.concatenate(
                [unpacked(x) for x in own.column("levels").to_pylist()])
            levels.append(found[at])
        first = np.cumsum(sizes) - sizes
        own = [pc.list_flatten(chunk.column(c)) for c in ("row", "doc_id", "held_out", "sizes")]
        return pa.table([*own, *_known(heavy.value, all_, first),
                         pa.array(np.add.reduceat(smoothing.log10(*levels), first))], SCORED)
    return run


def _light_chunks(heavy):
    def run(batches):
        for batch in batches:
            for i, rows in enumerate(batch.column("row").to_pylist()):
                yield _rest(heavy.value, np.array(rows, np.int64), *_tokens_of(batch, i))
    return run


def _score_by_table(rows: DataFrame, kind: str, segments: int, n: int, v: int, total: int, heavy,
                    fields: str) -> tuple[DataFrame, DataFrame]:
    """What `_scores` and `_light` give, with a filter of any size."""
    probes, block = probes_of(v), min(BLOCK, max(1, segments // 64))
    # stored: chunks and row numbers depend on how the files are split. By chunk, so that levels go to them
    chunks = bucketed(rows.mapInArrow(
        _stored_chunks, f"chunk long, row array<long>, doc_id array<{kind}>, held_out array<boolean>, "
        "sizes array<long>, words array<binary>, at binary"), "chunk")
    # with few training texts among many, a segment is built and asked in several places
    places = max(1, total // max(1, 2 * n))
    answers = stored(chunks.select("chunk", "held_out", "sizes", "words", "at").mapInArrow(
        _sent(segments, block, places),
        "chunk long, grp int, place long, asks boolean, ord int, keys binary, counts binary").groupBy(
        "grp", "place").applyInArrow(
        _answered(block, probes), "chunk long, grp int, ord int, levels binary, rate double"))
    rate = answers.agg(F.coalesce(F.sum("rate"), F.lit(0.0))).first()[0] / segments
    answers = answers.where(F.col("chunk").isNotNull()).drop("rate")
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _chunk_scores(Smoothing(n, v, rate), segments, heavy), fields)
    return scored, chunks.select("row", "sizes", "words", "at").mapInArrow(
        _light_chunks(heavy), "row long, h long, k int")


def score(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts, learnt from those for which held_out (a column) is not true."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.col(text).alias("text"))
    rows = numbered(docs, "row")  # it is read twice
    vocabulary = stored(rows.select("text", (~F.col("held_out")).alias("train")).mapInArrow(
        _words, "h long, c long, total long").groupBy("h").agg(
        F.sum("c").alias("c"), F.sum("total").alias("total")))
    n, v, total = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0),
                                 F.coalesce(F.sum("total"), F.lit(0))).first()
    limit = max(1, -(-total // HEAVY))
    often = vocabulary.where(F.col("total") >= limit).select("h", "c").toArrow()
    often_h = often.column("h").to_numpy().view(np.uint64)
    order = np.argsort(often_h)
    context = docs.sparkSession.sparkContext
    heavy = context.broadcast((often_h[order], often.column("c").to_numpy()[order]))

    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = (f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, "
              "score double")
    segments = segments_of(n, probes_of(v))
    if segments * (SEGMENT // 8) <= MOST_BYTES:
        model = context.broadcast(learn(rows.where(~F.col("held_out")), n, v))
        scored = rows.mapInArrow(_scores(model, heavy), fields)
        light = rows.select("row", "text").mapInArrow(_light(heavy), "row long, h long, k int")
    else:
        scored, light = _score_by_table(rows, kind, segments, n, v, total, heavy, fields)
    light = light.join(
        vocabulary.where(F.col("total") < limit).select("h", "c"), "h", "left")
    c = F.coalesce("c", F.lit(0))
    light = light.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("more_known"),
        F.sum(F.col("k") * F.log10(c + 0.5)).alias("more_base"))
    norm = float(np.log10(n + 0.5 * (v + 1)))
    return scored.join(light, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * norm)
        .alias("base_score"), "score")
