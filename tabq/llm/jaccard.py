"""Components of texts whose shingle sets are similar, by prefixes of token combinations.

A text's set holds its distinct five-word shingles. Two sets x and y link if |x & y| / |x | y| is at
least 3/4, so each misses at most m = n - ceil(3n/4) of its n shingles in the other. All sets are
read in one global order, rare shingles first. A prefix of x is extended until whatever m shingles
are taken out, a signature is left:

* a rare shingle is a signature by itself and counts 1;
* frequent shingles are dealt into classes, a pair of one class is a signature, and a class of c
  shingles counts c - 1, as many as must go before no pair is left.

With a count of m + 1 the smaller prefix of any linked pair shares a signature with the other. How
many classes there are depends on the set's size by powers of two; a set also serves the next power
if a partner could be there. Sets of up to seven shingles use all subsets they could share instead,
and so do, besides, sets of eight and nine, which can be their partners.

The order comes from a sketch of fixed size that all shingles are counted in; being coarse costs
candidates, never links. Candidates are verified exactly, in steps. First each bucket of a
signature forms a star around its smallest set, and the links found are closed to components; where
a bucket holds several of them, it forms one around the set that meets the most others and two around
sets drawn by hash, others in other buckets. Then only pairs of one bucket that are still in different
components are verified. So a group of many
copies costs one comparison for each of its members and bucket, not all its pairs, and no link is
lost. A pair that could not share enough even if all shingles from its signature on agree is not
compared; nor are sets that share frequent shingles alone, but have too few of them; nor are sets
whose parity bits (is the number of shingles in each of BITS cells odd?) differ in more cells than
linked sets can differ in shingles. Buckets that can be hot are dealt with a salt, as stars of stars.

Sets are named by 64-bit hashes, which equal sets share: copies are one node from the start.

Defined results: NULL, empty or white texts have the empty set and are their own component. Texts of
one to four words have their whole sequence as the one shingle. Rows that share a doc_id each get a
row; a NULL doc_id is never a component's name, unless the component has no other (then NULL). An
empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabq.llm.common import (
    checkpoint,
    column_bytes,
    folded_words,
    hashes,
    mix,
    slices,
    small_batches,
    stored,
)

WORDS = 5
CELLS = 1 << 22  # of the sketch
CHUNK = 1 << 16
SMALL = 7  # sets up to here use subsets alone
SUBSETS = 9  # and their partners, up to here, subsets too
SALTS = 32
FILTER_BITS = 1 << 24  # of the filter for texts to compare
BITS = 512  # of a set's parities
PARITY = [f"p{k}" for k in range(BITS // 64)]
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingles(text: bytes) -> np.ndarray:
    """The sorted set of shingle hashes."""
    words = folded_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h, n = hashes(words), min(WORDS, len(words))
    key = h[:len(h) - n + 1].copy()
    for i in range(1, n):
        key = key * _STEP + h[i:len(h) - n + 1 + i]
    return np.unique(mix(key, n))


def name_of(keys: np.ndarray) -> int:
    """The node of a set, as a signed 64-bit number."""
    return int((mix(keys, 1).sum(dtype=np.uint64) + np.uint64(len(keys))).view(np.int64))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    small, large = sorted((len(x), len(y)))
    if not small or 100 * small < 75 * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 75 * (len(x) + len(y) - both)


def parities(keys: np.ndarray) -> np.ndarray:
    """Bits of the cells with an odd number of shingles, as signed 64-bit numbers. Two sets differ in at
    least as many shingles as their bits differ in places."""
    odd = np.bincount((mix(keys, 7) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def cells(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(CELLS - 1)).astype(np.int64)


# --- first pass: the sets' names and sizes, and the sketch ---


_DESCRIBED = "doc_id long, n long, node long, " + "".join(
    f"{p} long, " for p in PARITY) + "chunk int, counts binary"


def _describe(batches):
    names = ["doc_id", "n", "node", *PARITY, "chunk", "counts"]
    sketch = np.zeros(CELLS, np.uint32)
    for batch in (part for whole in batches for part in slices(whole)):
        n, node, bits = [], [], []
        for text in column_bytes(batch, "text"):
            keys = shingles(text)
            sketch[cells(keys)] += 1  # a set has few equal cells; one is counted
            n.append(len(keys))
            node.append(name_of(keys) if len(keys) else None)
            bits.append(parities(keys))
        rows = len(n)
        bits = np.array(bits, np.int64).reshape(rows, len(PARITY))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
             *(pa.array(np.ascontiguousarray(column)) for column in bits.T),
             pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
    nothing = [pa.nulls(1, pa.int64())] * (3 + len(PARITY))
    for chunk in range(CELLS // CHUNK):
        part = np.minimum(sketch[chunk * CHUNK:(chunk + 1) * CHUNK], 255).astype(np.uint8)
        if part.any():
            yield pa.RecordBatch.from_arrays(
                [*nothing, pa.array([chunk], pa.int32()),
                 pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=names)


def _added(key, table):
    total = np.zeros(CHUNK, np.uint64)
    for part in table.column("counts"):
        total += np.frombuffer(zlib.decompress(part.as_py()), np.uint8)
    levels = np.minimum(8 * np.log2(1.0 + total), 255).astype(np.uint8)  # an eighth of an octave
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()),
                     "levels": pa.array([levels.tobytes()], pa.binary())})


def _levels(described: DataFrame) -> np.ndarray:
    """The sketch as log counts; CELLS bytes reach the driver."""
    levels = np.zeros(CELLS, np.uint8)
    for row in described.where("chunk is not null").select("chunk", "counts").groupBy(
            "chunk").applyInArrow(_added, "chunk int, levels binary").collect():
        levels[row.chunk * CHUNK:(row.chunk + 1) * CHUNK] = np.frombuffer(row.levels, np.uint8)
    return levels


def frequent_from(levels: np.ndarray) -> int:
    """The level from which a shingle is frequent: far above what a cell holds by chance."""
    mean = float((2.0 ** (levels / 8.0) - 1).mean())
    return int(8 * np.log2(1 + mean + 6 * mean ** 0.5 + 32)) + 1


# --- second pass: signatures ---


def signatures(keys: np.ndarray, levels: np.ndarray,
               frequent: int) -> tuple[np.ndarray, int, np.ndarray]:
    """Signatures of a set, those of rare shingles first; the number of those; and for each, how many
    shingles a partner can share if they meet by this signature and by no earlier rare one."""
    n = len(keys)
    missing = n - (3 * n + 3) // 4
    subsets = _subsets(keys, missing) if n <= SUBSETS else keys[:0]
    whole = np.full(len(subsets), n)
    if n <= SMALL:
        return subsets, 0, whole
    level = levels[cells(keys)]
    order = np.lexsort((keys, level))
    keys, often = keys[order], level[order] >= frequent
    after = np.arange(n, 0, -1)  # what is left from each place on
    if not often[:missing + 1].any():  # rare shingles alone reach the count
        return (np.concatenate((mix(keys[:missing + 1], 4), subsets)), missing + 1,
                np.concatenate((after[:missing + 1], whole)))
    rare, pairs = 0, []
    size = 1 << (n.bit_length() - 1)
    for s in (size, 2 * size) if 4 * n >= 6 * size else (size,):
        classes = max(1, s // 6)
        own = (mix(keys, 5) % np.uint64(classes)).astype(np.int64)
        later = np.ones(n, bool)
        later[np.flatnonzero(often)[np.unique(own[often], return_index=True)[1]]] = False
        end = int(np.searchsorted(np.cumsum(~often | later), missing + 1)) + 1
        rare = max(rare, int((~often[:end]).sum()))
        chosen = np.flatnonzero(often[:end])
        chosen = chosen[np.lexsort((keys[chosen], own[chosen]))]
        a, c = keys[chosen], own[chosen]
        for lag in range(1, len(a)):
            same = c[lag:] == c[:-lag]
            if not same.any():
                break
            pairs.append(mix(mix(a[:-lag][same], s) + mix(a[lag:][same], s + 1) * _STEP, 6))
    # if a partner shares a rare shingle, it meets the set there; else it shares frequent ones only
    number = int(often.sum())
    if 4 * number < 3 * n:
        pairs = []
    bounds = np.concatenate((after[:rare], np.full(sum(map(len, pairs)), number), whole))
    return np.concatenate([mix(keys[:rare], 4), *pairs, subsets]), rare, bounds


def _subsets(keys: np.ndarray, missing: int) -> np.ndarray:
    """A hash of each subset that leaves out up to `missing` (0 to 2) shingles."""
    each = mix(keys, 2)
    sums = [np.array([each.sum(dtype=np.uint64)])]
    for _ in range(missing):
        sums.append(np.unique((sums[-1][:, None] - each[None]).ravel()))
    return mix(np.concatenate(sums), 3)


def _sign(shared):
    def run(batches):
        levels, frequent = shared.value
        seen = set()  # copies within the task sign once
        for batch in (part for whole in batches for part in slices(whole)):
            signs, nodes, facts = [], [], []
            for text in column_bytes(batch, "text"):
                keys = shingles(text)
                if not len(keys) or (node := name_of(keys)) in seen:
                    continue
                seen.add(node)
                found, rare, most = signatures(keys, levels, frequent)
                fact = (len(keys) << 28) + most  # size and bound; negative: the bucket can be hot
                fact[rare:] *= -1
                signs.append(found)
                nodes.append(np.full(len(found), node))
                facts.append(fact)
            if signs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(signs).view(np.int64)), pa.array(np.concatenate(nodes)),
                     pa.array(np.concatenate(facts))], names=["sig", "node", "facts"])
    return run


# --- verification ---


def _texts(wanted):
    """Texts of wanted sets, one for each set and task."""
    def run(batches):
        seen = set()
        for batch in (part for whole in batches for part in slices(whole)):
            nodes, texts = [], []
            for text in column_bytes(batch, "text"):
                keys = shingles(text)
                if len(keys) and (node := name_of(keys)) not in seen and _marked(wanted.value, node):
                    seen.add(node)
                    nodes.append(node)
                    texts.append(text)
            if nodes:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(texts, pa.binary())], ["node", "text"])
    return run


def _marked(bits: bytes, node: int) -> int:
    at = node % FILTER_BITS
    return bits[at >> 3] >> (at & 7) & 1


def _chosen(wanted):
    """Rows of stored texts that are wanted."""
    def run(batches):
        for batch in batches:
            keep = [bool(_marked(wanted.value, node)) for node in batch.column("node").to_pylist()]
            yield batch.filter(pa.array(keep))
    return run


def _verify(batches):
    last, known = None, None
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        one, two = batch.column("text_a"), batch.column("text_b")
        keep = []
        for i, node in enumerate(a):
            if node != last:
                last, known = node, shingles(one[i].as_py())
            keep.append(similar(known, shingles(two[i].as_py())))
        mask = np.array(keep, bool)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(a, np.int64)[mask]), pa.array(np.array(b, np.int64)[mask])],
            names=["a", "b"])


def _filter(nodes: DataFrame):
    """A broadcast bit filter of fixed size: it keeps most other texts from moving, and passes some."""
    at = F.pmod("node", F.lit(FILTER_BITS))
    chunks = nodes.select(at.alias("at")).groupBy((F.col("at") / 32768).cast("int").alias("chunk")).agg(
        F.bitmap_construct_agg((F.col("at") % 32768)).alias("bits")).collect()
    bits = bytearray(FILTER_BITS // 8)
    for row in chunks:
        bits[row.chunk * 4096:(row.chunk + 1) * 4096] = row.bits
    return nodes.sparkSession.sparkContext.broadcast(bytes(bits))


def _links(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar. texts: (node, text), at least those of the pairs."""
    def of(side):
        own = texts.mapInArrow(_chosen(_filter(pairs.select(F.col(side).alias("node")))), texts.schema)
        return own.groupBy("node").agg(F.min("text").alias(f"text_{side}")).withColumnRenamed(
            "node", side)  # copies come from several tasks

    return pairs.join(of("b"), "b").join(of("a"), "a").select(
        "a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that reaches a smaller one; root is the smallest. Alternates stars
    around smallest neighbours until only stars around roots are left. The driver keeps a record of every
    task, so a round has few shuffles: edges are stored, as empty parts of a checkpoint are tasks too."""
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .where("u <> v").distinct())
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = wide.groupBy("u").agg(F.min("v").alias("m"))
        edges = stored(wide.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v")).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Has every node with a smaller neighbour v one only, that has none itself?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up + down > 1 and up > 0").agg(F.count("*")).first()[0]


def _known(roots: DataFrame) -> DataFrame:
    """Components as links, so that what comes next goes on from their stars."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _may_link():
    """Can two sets of a bucket share enough? The overlap must be 3/7 of both sizes' sum."""
    return 7 * F.least("most", "most2") >= 3 * (F.col("n") + F.col("n2"))


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their roots, of buckets that hold several components."""
    known = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = known.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low <> high").select("sig")
    return known.join(several, "sig").select("sig", "node", "n", "most", "root")


def _distinct_buckets(members: DataFrame) -> DataFrame:
    """Buckets (sig, node, n, most) of several sets, one for all signatures that the same sets share:
    copies of a passage share a signature for each of its rare shingles. The greatest bound serves. Equal
    sets of nodes are known by a hash; if others have it too, their buckets become one and lose no pair."""
    members = members.select("sig", "node", "n", "most").distinct()
    met = members.groupBy("sig").agg(
        F.bit_xor(F.xxhash64("node")).alias("by"), F.count("*").alias("size")).where("size > 1")
    return members.join(met.drop("size"), "sig").groupBy(F.col("by").alias("sig"), "node").agg(
        F.max("n").alias("n"), F.max("most").alias("most"))


def _near(two: str):
    """Do the parities differ in no more places than linked sets can differ in shingles? These are a
    seventh of both sizes' sum. The other set's columns end in `two`."""
    places = sum(F.bit_count(F.col(p).bitwiseXOR(F.col(p + two))) for p in PARITY)
    return 7 * places <= F.col("n") + F.col("n" + two)


def _close(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) whose parities are near."""
    other = bits.select(F.col("node").alias("b"), *(F.col(c).alias(c + "2") for c in ("n", *PARITY)))
    return pairs.join(bits.withColumnRenamed("node", "a"), "a").join(other, "b").where(
        _near("2")).select("a", "b")


def _possible(met: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of sets that met and may link."""
    return met.where((F.col("node") != F.col("node2")) & _may_link()).select(
        F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = checkpoint(docs.mapInArrow(_describe, _DESCRIBED))
    levels = _levels(described)
    rows = described.where("chunk is null").select("doc_id", "n", "node")
    bits = described.where("node is not null").groupBy("node").agg(
        F.min("n").cast("int").alias("n"), *(F.min(p).alias(p) for p in PARITY))

    shared = docs.sparkSession.sparkContext.broadcast((levels, frequent_from(levels)))
    signed = docs.select("text").mapInArrow(
        _sign(shared), "sig long, node long, facts long")
    # one column for the salt, so that both windows share a shuffle
    signed = signed.withColumn("salt", F.when(
        F.col("facts") < 0, F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0))
    bucket = Window.partitionBy("sig", "salt")
    starred = signed.withColumn("lead", F.min(F.struct("node", "facts")).over(bucket)).withColumn(
        "last", F.max("node").over(bucket))
    # what is alone in its bucket has no partner; of salted buckets that shows later
    members = stored(starred.where("facts < 0 or last > lead.node").select(
        "sig", F.col("facts").alias("own_facts"), "node", F.col("lead.node").alias("node2"),
        F.col("lead.facts").alias("lead_facts")))
    facts = [(F.abs(f"{name}_facts") / (1 << 28)).cast("int").alias(n) for name, n in
             (("own", "n"), ("lead", "n2"))] + [
        (F.abs(f"{name}_facts") % (1 << 28)).cast("int").alias(n) for name, n in
        (("own", "most"), ("lead", "most2"))]
    hot = members.where("own_facts < 0")
    members = members.select("sig", "node", "node2", *facts)

    leads = hot.select("sig", *facts, "node2").select(
        "sig", F.struct(F.col("node2").alias("node"), F.col("n2").alias("n"),
                        F.col("most2").alias("most")).alias("own")).distinct().withColumn(
        "lead", F.min("own").over(Window.partitionBy("sig"))).select(
        F.col("own.node").alias("node"), F.col("lead.node").alias("node2"), F.col("own.n").alias("n"),
        F.col("lead.n").alias("n2"), F.col("own.most").alias("most"),
        F.col("lead.most").alias("most2"))
    pairs = stored(_close(_possible(members.drop("sig").unionByName(leads)), bits))
    # all texts that can be compared, now or below
    texts = stored(docs.select("text").mapInArrow(
        _texts(_filter(members.select("node"))), "node long, text binary"))
    roots = components(_links(texts, pairs))

    # Once more in buckets that hold several components. Around the set that meets the most others:
    # copies that were changed in different places may be similar to their origin only. And around two
    # drawn ones: members that link with a share of the others grow together by a few such stars.
    mixed = stored(_mixed(_distinct_buckets(members), roots))
    met = mixed.join(mixed.groupBy("sig").agg(F.count("*").alias("size")), "sig").groupBy("node").agg(
        F.sum("size").alias("weight"))
    drawn = F.xxhash64("node", "sig")
    centres_by = {"meets": F.col("weight"), "drawn": drawn, "other": -F.shiftright(drawn, 1)}
    centres = mixed.join(met, "node").groupBy("sig").agg(*(
        F.max(F.struct(by.alias("by"), "node", "n", "most", "root")).alias(name)
        for name, by in centres_by.items()))
    leads = centres.select("sig", F.explode(F.array_distinct(F.array(
        *(F.struct(*(F.col(f"{name}.{c}").alias(c) for c in ("node", "n", "most", "root")))
          for name in centres_by)))).alias("lead"))
    starred = mixed.join(leads, "sig").select(
        "node", "n", "most", "root", *(F.col(f"lead.{c}").alias(c + "2")
                                       for c in ("node", "n", "most", "root")))
    more = stored(_close(_possible(starred.where("root <> root2")).join(
        pairs, ["a", "b"], "left_anti"), bits))
    pairs = pairs.union(more)
    roots = components(_known(roots).union(_links(texts, more)))

    # all pairs of one bucket that the stars left in different components
    mixed = stored(_mixed(mixed.drop("root"), roots).join(bits.drop("n"), "node"))
    # aliases, not new names: so both sides are one shuffle
    met = mixed.alias("one").join(mixed.alias("two"), F.col("one.sig") == F.col("two.sig")).select(
        *(F.col(f"one.{c}") for c in mixed.columns),
        *(F.col(f"two.{c}").alias(c + "2") for c in mixed.columns))
    found = met.where((F.col("root") < F.col("root2")) & _may_link() & _near("2"))
    rest = stored(_possible(found).join(pairs, ["a", "b"], "left_anti"))
    roots = components(_known(roots).union(_links(texts, rest)))

    named = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(
        roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(names, "root").select("node", "component")
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
        .alias("component_id"))
