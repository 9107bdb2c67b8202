"""Byte-level BPE encoding and decoding by tree reduction.

The encodings of two neighbouring byte strings have an associative join. Each piece is halved down to
single bytes, and the halves are joined up the tree. A join re-encodes a window of tokens around the
seam and widens it, on the side that needs it, until its outer tokens and their neighbours outside
stay apart when encoded as a pair. A sequence in which all neighbours stay apart is the encoding of
its bytes, so the tokens outside are final. A worker remembers the results of short subtrees, whole
pieces among them; nothing else is looked up.

Text is cut by a pattern first; merges never cross a cut, so the encodings of pieces are joined by
putting them in a row. A piece that is itself in the vocabulary is that token, also where merges do
not lead there. Decoding puts the bytes of neighbours together, level by level up a tree.

Ids are kept as little-endian unsigned 32-bit integers in a binary column.

Defined results: NULL and empty texts have no ids; NULL ids decode to no bytes. Special tokens do not
exist. Texts and pieces of any length are encoded whole. Equal rows get equal results, one each; an
empty table gives no rows. Columns of the input that have the names of the new ones are replaced.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from tabq.llm.common import append, column_texts

CACHED = 400_000  # pieces, subtrees and pairs each that a worker remembers
CACHED_CHARS = 48
NONE = 1 << 32


class Codec:
    """Ranks of one vocabulary file, with the pieces that were met."""

    def __init__(self, path: str, pattern: str):
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes[rank] = token
        self.findall = regex.compile(pattern).findall
        self.seams: dict[tuple[int, int], list[int]] = {}
        self.subtrees: dict[bytes, list[int]] = {}
        self.known = _Known(self)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.findall(text)))

    def piece(self, piece: bytes) -> list[int]:
        found, rank = self.reduce(piece), self.ranks.get(piece)
        return found if rank is None else [rank]

    def reduce(self, data: bytes) -> list[int]:
        """Encode the halves and join them."""
        if len(data) == 1:
            return [self.ranks[data]]
        found = self.subtrees.get(data)
        if found is None:
            middle = 1 << ((len(data) - 1).bit_length() - 1)  # powers of two keep runs aligned
            found = self.join(self.reduce(data[:middle]), self.reduce(data[middle:]))
            if len(data) <= CACHED_CHARS:
                if len(self.subtrees) >= CACHED:
                    self.subtrees.clear()
                self.subtrees[data] = found
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        window = self.seam(left[-1], right[0])
        i = j = 1
        while True:
            left_final = i == len(left) or self.stays(left[-i - 1], window[0])
            right_final = j == len(right) or self.stays(window[-1], right[j])
            if left_final and right_final:
                return left[:-i] + window + right[j:]
            i = i if left_final else min(2 * i, len(left))
            j = j if right_final else min(2 * j, len(right))
            window = self.merge(b"".join([self.bytes[t] for t in left[-i:] + right[:j]]))

    def seam(self, a: int, b: int) -> list[int]:
        """Two tokens encoded together."""
        found = self.seams.get((a, b))
        if found is None:
            if len(self.seams) >= CACHED:
                self.seams.clear()
            found = self.seams[a, b] = self.merge(self.bytes[a] + self.bytes[b])
        return found

    def stays(self, a: int, b: int) -> bool:
        """Do these two tokens stay apart when encoded together?"""
        return self.seam(a, b) == [a, b]

    def merge(self, data: bytes) -> list[int]:
        """The pair of the lowest rank, the leftmost first, becomes one token until none is left."""
        ranks = self.ranks
        if len(data) > 64:
            return self._merge_long(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [ranks.get(data[i:i + 2], NONE) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) < NONE:
            at = pairs.index(best)
            parts[at] += parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], NONE)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], NONE)
        return [ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap and links, for windows that grew."""
        ranks, n = self.ranks, len(data)
        parts: list = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            if parts[i] is None or after[i] >= n or len(parts[i]) + len(parts[after[i]]) != size:
                continue
            k = after[i]
            parts[i], parts[k] = parts[i] + parts[k], None
            after[i] = after[k]
            if after[i] < n:
                before[after[i]] = i
                joined = parts[i] + parts[after[i]]
                if (r := ranks.get(joined)) is not None:
                    heapq.heappush(heap, (r, i, len(joined)))
            if (b := before[i]) >= 0:
                joined = parts[b] + parts[i]
                if (r := ranks.get(joined)) is not None:
                    heapq.heappush(heap, (r, b, len(joined)))
        return [ranks[p] for p in parts if p is not None]

    def decode(self, ids: np.ndarray) -> bytes:
        parts = [self.bytes[i] for i in ids.tolist()]
        while len(parts) > 1:
            odd = parts[-1:] if len(parts) % 2 else []
            parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + odd
        return parts[0] if parts else b""


class _Known(dict):
    """Ids of pieces as bytes; of short pieces so many are kept."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.codec.piece(piece.encode("utf-8")), "<u4").tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """df's columns `keep` (default: all) and the ids of its texts."""

    def work(batch):
        own = codec(path, pattern)
        return [[own.encode(t) for t in column_texts(batch, text)]]

    return append(df, work, f"`{ids}` binary", keep)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """df's columns `keep` (default: all) and the bytes of its ids."""

    def work(batch):
        own = codec(path, pattern)
        return [[own.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(ids).to_pylist()]]

    return append(df, work, f"`{data}` binary", keep)
