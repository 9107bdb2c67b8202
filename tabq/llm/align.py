"""Alignment of two tokenizers, with an identity map as the fast path.

A text is cut by tokenizer A (a byte-level BPE file of `tokenizers`, given a blank and the text) and by
B (a sentencepiece model, which puts the blank itself). Where both end a token, a group ends. The map
`same` names for each A id the B id of the same bytes. A group of one A token and its B token by that
map is regular: all it takes to count it is its A id, in a vector as long as A's vocabulary. All other
groups are irregular: each pair of tokens that share bytes is a link, and only these links enter the
shuffle that counts pairs of ids, summed up in each task before.

Counts come back to the texts in two ways. Pairs of the identity map and pairs that hold at least
1/FREQUENT of all links (so at most FREQUENT of them) are sent to all tasks as one sorted table. The
others, of which none is frequent, are joined by pair; no key of that join is hot.

Defined results: texts that are NULL, empty, or that A's or B's tokens do not give back byte by byte
(with the blank in front) have no tokens: zeros and an empty digest. Strings of special tokens are
plain text. Repeated rows count again; NULL ids are kept. An empty table gives no rows. Other columns
of the input are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabq.llm.common import append, column_texts, small_batches, stored
from tabq.llm.packing import encoder

FREQUENT = 1 << 18  # pairs sent to all tasks at most, 16 bytes each
HELD = 1 << 21  # links a task holds before it sums them up
CHUNK = 1 << 21  # bytes of text aligned at once
COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


class Pair:
    """Two tokenizers, the bytes of their entries and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        self.a = encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a_bytes = [b""] * self.a.n_vocab
        for token in self.a.token_byte_values():
            self.a_bytes[self.a.encode_single_token(token)] = token
        self.b_bytes = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else
            piece.replace("▁", " ").encode("utf-8")
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        self.size_a, self.size_b = len(self.a_bytes), len(self.b_bytes)
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # of two B entries with the same bytes the later is the piece, the earlier the single byte
        by_bytes = {x: i for i, x in enumerate(self.b_bytes)
                    if not self.b.is_control(i) and not self.b.is_unknown(i)}
        self.same = np.array([by_bytes.get(x, -1) if x else -1 for x in self.a_bytes])

    def encode(self, texts: list[str]) -> tuple[list, list, np.ndarray]:
        """A ids and B ids of each text, empty where one does not give the text back, and its bytes."""
        of_b = self.b.encode(texts, num_threads=1) if texts else []
        a, b, sizes = [], [], []
        for text, own in zip(texts, of_b):
            data = b" " + text.encode("utf-8")
            ids = self.a.encode_ordinary(" " + text) if text else []
            whole = (text and b"".join([self.a_bytes[i] for i in ids]) == data
                     and b"".join([self.b_bytes[i] for i in own]) == data)
            a.append(ids if whole else [])
            b.append(own if whole else [])
            sizes.append(len(data) if whole else 0)
        return a, b, np.array(sizes, np.int64)

    def keys(self) -> np.ndarray:
        """The pairs of the identity map, as A id * size of B + B id."""
        a = np.flatnonzero(self.same >= 0)
        return a * self.size_b + self.same[a]


@lru_cache(2)
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _digits(ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids in decimal, each followed by a byte of `after`, and where each ends."""
    shown = np.ones(len(ids), np.int64)
    ten = 10
    while ten <= ids.max(initial=0):
        shown += ids >= ten
        ten *= 10
    ends = np.cumsum(shown + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = after
    left = ids.copy()
    for place in range(int(shown.max(initial=0))):
        some = shown > place
        out[ends[some] - 2 - place] = 48 + left[some] % 10
        left //= 10
    return out, ends


def _per_text(of: np.ndarray, key: np.ndarray, texts: int, base: int):
    """Distinct keys of each text with their counts, as binary arrays of whole numbers."""
    both, counts = np.unique(of * base + key, return_counts=True)
    sizes = np.bincount(both // base, minlength=texts)
    kind = "<u4" if base <= 1 << 32 else "<u8"
    return _binary((both % base).astype(kind), sizes), _binary(counts.astype("<u4"), sizes)


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])


def align(own: Pair, texts: list[str]) -> list:
    """Of each text: COLUMNS, the digest of its groups, distinct A ids of its regular groups with counts,
    distinct pairs of its irregular links with counts."""
    lists_a, lists_b, sizes = own.encode(texts)
    n = len(texts)
    n_a = np.array([len(x) for x in lists_a], np.int64)
    n_b = np.array([len(x) for x in lists_b], np.int64)
    a, b = _flat(lists_a), _flat(lists_b)
    a_ends, b_ends, text_ends = np.cumsum(own.a_sizes[a]), np.cumsum(own.b_sizes[b]), np.cumsum(sizes)
    ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
    of_a, of_b = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
    group_text = np.searchsorted(text_ends, ends)
    in_a, in_b = np.bincount(of_a, minlength=len(ends)), np.bincount(of_b, minlength=len(ends))
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    regular = (in_a == 1) & (in_b == 1)
    regular[regular] = own.same[a[first_a[regular]]] == b[first_b[regular]]
    n_groups = np.bincount(group_text, minlength=n)

    # irregular links: every B token that ends after an A token's start and starts before its end
    at = np.flatnonzero(~regular[of_a])
    low = np.searchsorted(b_ends, a_ends[at] - own.a_sizes[a[at]], "right")
    met = np.searchsorted(b_ends, a_ends[at], "left") - low + 1
    left = np.repeat(at, met)
    right = np.repeat(low - (np.cumsum(met) - met), met) + np.arange(met.sum())
    pairs = _per_text(group_text[of_a[left]], a[left] * own.size_b + b[right], n,
                      own.size_a * own.size_b)
    same = _per_text(group_text[regular], a[first_a[regular]], n, own.size_a)

    # a1,a2|b1;...: the tokens of a group stand together, A's before B's
    ids, after = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    place_a = np.arange(len(a)) + first_b[of_a]
    place_b = np.arange(len(b)) + (first_a + in_a)[of_b]
    ids[place_a], ids[place_b] = a, b
    after[first_a + in_a - 1 + first_b] = ord("|")
    after[first_a + in_a + first_b + in_b - 1] = ord(";")
    out, shown = _digits(ids, after)
    edges = np.concatenate(([0], shown))[np.concatenate(([0], np.cumsum(n_a + n_b)))]
    data = memoryview(out)
    digests = [hashlib.sha256(data[s:t - 1]).hexdigest() if t > s else ""
               for s, t in zip(edges[:-1].tolist(), edges[1:].tolist())]
    return [n_a, n_b, n_groups, n_a + n_b - n_groups, digests, *same, *pairs]


def described(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """docs with what `align` finds in each text."""
    def work(batch):
        own = pair(path_a, path_b)
        return [x.tolist() if isinstance(x, np.ndarray) else x
                for x in align(own, column_texts(batch, text))]

    fields = (", ".join(f"{c} long" for c in COLUMNS) + ", groups_sha256 string, same binary, "
              "same_n binary, pairs binary, pairs_n binary")
    return append(docs, work, fields, [c for c in docs.columns if c != text], CHUNK)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]):
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, at, np.concatenate(counts))
    return key, total


def _arrays(batch: pa.RecordBatch, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a binary column, and how many each row holds."""
    data = batch.column(name).to_pylist()
    values = np.frombuffer(b"".join(data), kind)
    return values, np.array([len(x) for x in data], np.int64) // values.itemsize


def count(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """key (A id * size of B + B id) and n, the links of each pair in all texts."""
    def run(batches):
        own = pair(path_a, path_b)
        kind = "<u4" if own.size_a * own.size_b <= 1 << 32 else "<u8"
        vector = np.zeros(own.size_a, np.int64)
        keys, counts, held = [], [], 0
        for batch in batches:
            np.add.at(vector, _arrays(batch, "same", "<u4")[0], _arrays(batch, "same_n", "<u4")[0])
            keys.append(_arrays(batch, "pairs", kind)[0].astype(np.int64))
            counts.append(_arrays(batch, "pairs_n", "<u4")[0].astype(np.int64))
            held += len(keys[-1])
            if held > HELD:
                key, total = _summed(keys, counts)
                if len(key) > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total)], ["key", "n"])
                    key, total = key[:0], total[:0]
                keys, counts, held = [key], [total], len(key)
        met = np.flatnonzero(vector)
        keys.append(met * own.size_b + own.same[met])
        counts.append(vector[met])
        key, total = _summed(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total)], ["key", "n"])

    some = rows.select("same", "same_n", "pairs", "pairs_n")
    return some.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def links(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text",
          frequent: int = FREQUENT) -> DataFrame:
    """doc_id, COLUMNS, n_best (links whose pair is the most frequent of its B id), count_sum (the
    counts of all links' pairs) and groups_sha256 of each text."""
    spark = docs.sparkSession
    small_batches(spark)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
                           F.col(text).alias("text"))
    rows = stored(described(numbered, path_a, path_b))  # so that row numbers cannot change
    counts = stored(count(rows, path_a, path_b))
    own = pair(path_a, path_b)
    size_b = own.size_b
    total = counts.agg(F.sum("n")).first()[0] or 0
    identity = spark.createDataFrame(pa.table({"key": own.keys()}))  # a row for each A id at most
    is_frequent = F.col("n") * F.lit(frequent) >= F.lit(total)
    known = counts.join(F.broadcast(identity.withColumn("identity", F.lit(True))), "key", "left")
    known = known.where(is_frequent | F.col("identity")).select("key", "n").orderBy("key").toArrow()
    best = counts.groupBy((F.col("key") % size_b).alias("b")).agg(F.max("n").alias("most"))
    highest = np.zeros(size_b, np.int64)
    of_b = best.toArrow()  # a row for each B id at most
    highest[of_b.column("b").to_numpy()] = of_b.column("most").to_numpy()
    shared = spark.sparkContext.broadcast(
        (known.column("key").to_numpy(), known.column("n").to_numpy(), highest))

    def looked_up(batch):
        """Row, key, count in the text and corpus-wide count (-1: not known here) of each entry."""
        own = pair(path_a, path_b)
        kind = "<u4" if own.size_a * own.size_b <= 1 << 32 else "<u8"
        same, in_same = _arrays(batch, "same", "<u4")
        pairs, in_pairs = _arrays(batch, "pairs", kind)
        index = np.arange(batch.num_rows)
        row = np.concatenate((np.repeat(index, in_same), np.repeat(index, in_pairs)))
        key = np.concatenate((same * np.int64(size_b) + own.same[same], pairs.astype(np.int64)))
        n = np.concatenate((_arrays(batch, "same_n", "<u4")[0], _arrays(batch, "pairs_n", "<u4")[0]))
        table, values, _ = shared.value
        at = np.minimum(np.searchsorted(table, key), max(len(table) - 1, 0))
        met = table[at] == key if len(table) else np.zeros(len(key), bool)
        corpus = np.full(len(key), -1, np.int64)
        corpus[met] = values[at[met]]
        return row, key, n.astype(np.int64), corpus

    def rare(batches):
        for batch in batches:
            row, key, n, corpus = looked_up(batch)
            left = corpus < 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(row[left])), pa.array(key[left]), pa.array(n[left])],
                ["row", "key", "n"])

    def work(batch):
        row, key, n, corpus = looked_up(batch)
        n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        met = corpus >= 0
        np.add.at(count_sum, row[met], (n * corpus)[met])
        top = met & (corpus == shared.value[2][key % size_b])
        np.add.at(n_best, row[top], n[top])
        return [n_best.tolist(), count_sum.tolist()]

    others = counts.where(~is_frequent).withColumnRenamed("n", "corpus")
    bounded = F.broadcast(best)  # a row for each B id at most
    more = (rows.mapInArrow(rare, "row long, key long, n long").join(others, "key")
            .withColumn("b", F.col("key") % size_b).join(bounded, "b").groupBy("row").agg(
                F.sum(F.when(F.col("corpus") == F.col("most"), F.col("n")).otherwise(0)).alias("more_best"),
                F.sum(F.col("n") * F.col("corpus")).alias("more_sum")))
    first = append(rows, work, "n_best long, count_sum long",
                   ["row", "doc_id", *COLUMNS, "groups_sha256"])
    added = {c: F.col(c) + F.coalesce(F.col(m), F.lit(0))
             for c, m in (("n_best", "more_best"), ("count_sum", "more_sum"))}
    return first.join(more, "row", "left").withColumns(added).select(
        "doc_id", *COLUMNS, "n_best", "count_sum", "groups_sha256")
