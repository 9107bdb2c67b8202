"""Tokenizer alignment, hard negatives and passage removal against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from tabq.llm import align, negatives, substrings  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "  \n ", "a", "One two  three", "x " * 300, "ß é 中文 👍 \x00 ok", "▁ blank",
         "<|endoftext|> <s> </s> <0x41> <unk>", "long" * 3000, "tab\tand\x0bline\n\nend", "One two  three",
         "ﬁne ½ Å"]


# 11 alignment ---------------------------------------------------------------------------------------


def brute_alignment(texts):
    """Tokens, groups and links by walking both token lists byte by byte."""
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    own = align.pair(A, B)
    found = []
    for text in texts:
        data = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = own.b.encode(text) if text else []
        if (b"".join(own.a_bytes[i] for i in a) != data or b"".join(own.b_bytes[i] for i in b) != data):
            a, b = [], []
        of_byte = [[], []]
        for side, ids, names in ((0, a, own.a_bytes), (1, b, own.b_bytes)):
            for at, i in enumerate(ids):
                of_byte[side] += [at] * len(names[i])
        links = Counter((a[x], b[y]) for x, y in set(zip(*of_byte)))
        groups, ga, gb, at = [], [], [], 0
        ends = [set(np.cumsum([len(n[i]) for i in ids]).tolist())
                for ids, n in ((a, own.a_bytes), (b, own.b_bytes))]
        for at in range(len(data) if a else 0):
            if not ga or of_byte[0][at] != ga[-1]:
                ga.append(of_byte[0][at])
            if not gb or of_byte[1][at] != gb[-1]:
                gb.append(of_byte[1][at])
            if at + 1 in ends[0] and at + 1 in ends[1]:
                groups.append(",".join(str(a[i]) for i in ga) + "|" + ",".join(str(b[i]) for i in gb))
                ga, gb = [], []
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    return found


@pytest.mark.parametrize("frequent", [align.FREQUENT, 10, 0])
def test_alignment_matches_brute_force(spark, frequent):
    rows = list(enumerate(TEXTS)) + [(3, "One two  three"), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("row", "key", "n", "same", "n_a")}).repartition(3)
    expected = brute_alignment([t for _, t in rows])
    pairs, highest = Counter(), Counter()
    for *_, links, _ in expected:
        pairs.update(links)
    for (_, b), n in pairs.items():
        highest[b] = max(highest[b], n)
    want = Counter()
    for (i, _), (n_a, n_b, n_groups, links, groups) in zip(rows, expected):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        want[(i, n_a, n_b, n_groups, sum(links.values()),
              sum(n for k, n in links.items() if pairs[k] == highest[k[1]]),
              sum(n * pairs[k] for k, n in links.items()), digest)] += 1
    got = align.links(df, A, B, frequent=frequent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == want


def test_alignment_uses_the_identity_map():
    own = align.pair(A, B)
    assert all(own.a_bytes[a] == own.b_bytes[b] for a, b in enumerate(own.same) if b >= 0)
    *_, same, same_n, pairs, pairs_n = align.align(own, ["the house of the people"])
    regular = np.frombuffer(same_n[0].as_py(), "<u4").sum()
    irregular = np.frombuffer(pairs_n[0].as_py(), "<u4").sum()
    assert regular == 5 and irregular == 0


def test_alignment_of_nothing(spark):
    assert align.links(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
    blank = align.links(spark.createDataFrame([(1, None)], "doc_id long, text string"), A, B).first()
    assert tuple(blank) == (1, 0, 0, 0, 0, 0, 0, "")


# 12 hard negatives ----------------------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives_=3):
    whole = [(v, lab, np.floor(256 * np.array(x, float)).astype(np.int64)) for v, x, lab in rows
             if lab is not None and x and all(c is not None and np.isfinite(c) for c in x)]
    out = Counter()
    for i, (v, lab, x) in enumerate(whole):
        if v % 5:
            continue
        scored = [(-int(x @ y), w, j, m == lab) for j, (w, m, y) in enumerate(whole)
                  if j != i and len(y) == len(x)]
        for p, pid, *_ in sorted(s for s in scored if s[3])[:positives]:
            fits = sorted(s for s in scored if not s[3] and 50 * -p <= 100 * -s[0] <= 95 * -p)
            for rank, (n, nid, *_) in enumerate(fits[:negatives_], 1):
                out[v, pid, rank, nid, -p, -n] += 1
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns(
        {c: F.lit(1) for c in ("row", "block", "deal", "goal", "score", "cluster")}).repartition(4)


@pytest.mark.parametrize("block,deal", [(negatives.BLOCK, negatives.DEAL), (40, 7)])
def test_negatives_match_brute_force(spark, monkeypatch, block, deal):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "DEAL", deal)
    monkeypatch.setattr(negatives, "CLUSTERS", 9)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 6))
    rows = [(i, [float(c) for c in centres[i % 8] + rng.normal(scale=0.4, size=6)], i % 3) for i in range(300)]
    rows += [(1000 + i, rows[20][1], i % 3) for i in range(60)]  # a hot direction with ties
    rows += [(400, None, 1), (405, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (410, rows[3][1], None),
             (415, [float("nan")] * 6, 0), (420, [0.0] * 6, 0), (425, [], 1), (20, rows[20][1], 2),
             (430, [1.0, 2.0], 0), (431, [1.0, 2.1], 0), (432, [1.0, 1.2], 1)]
    got = negatives.mine(vectors(spark, rows), F.col("vec_id") % 5 == 0)
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mine(none, F.col("vec_id") % 5 == 0).count() == 0
    alone = vectors(spark, [(5, [1.0, 0.0], 1), (6, [1.0, 0.0], 1)])
    assert negatives.mine(alone, F.col("vec_id") % 5 == 0).count() == 0


def test_walks_stop_early_on_clustered_vectors():
    """The shared list ends the walk long before all scores are computed."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    data = np.floor(256 * (np.repeat(centres, 200, 0) + rng.normal(scale=0.05, size=(4000, 16)))).astype(np.int64)
    anchors, rows = data[:50], np.arange(4000)
    units, _ = negatives.directions(anchors)
    centre = units.mean(0) / np.linalg.norm(units.mean(0))
    radius = float(np.arccos(np.clip(units @ centre, -1, 1)).max())
    labels = rows % 2
    low, high = np.full(50, negatives.NONE), np.full(50, -negatives.NONE)
    found, scored = negatives.walk(anchors, np.arange(50), rows[:50], labels[:50], low, high,
                                   (data, rows, rows, labels), centre, radius, 5, True)
    scores = anchors @ data.T
    for g in range(50):
        fits = [(-scores[g, j], j) for j in rows if labels[j] == labels[g] and j != g]
        assert [(c, s) for q, c, s in found if q == g] == [(j, -s) for s, j in sorted(fits)[:5]]
    assert scored < 0.25 * scores.size


def test_deals_bound_every_part():
    counts = [(2, 0, 5), (2, 1, 3), (2, 2, 100), (2, 3, 1), (3, 4, 1)]
    made = {c: (d, p) for c, d, p in negatives.deals(counts, 10)}
    assert made[0] == made[1] == (0, 1) and made[2] == (1, 10)
    assert made[3][0] == 11 and made[4][0] == 12


# 13 passages ----------------------------------------------------------------------------------------


def brute_passages(rows):
    """rows of (doc_id, text), in the order of documents."""
    seen, out = set(), {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k:k + 20])
            if window in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def passages():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    line = rng.choices(words, k=26)
    base = rng.choices(words, k=300)
    texts = [None, "", " \n", "one two", " ".join(line[:19]), " ".join(line[:20]), " ".join(line),
             "a " * 90, "b c d " * 40, " ".join(base), " ".join(base)]
    for _ in range(60):  # a passage in ever other surroundings, and edited copies
        own = rng.choices(words, k=rng.randint(0, 80))
        at = rng.randint(0, len(own))
        cut = rng.randint(15, 26)
        texts.append(" ".join(own[:at] + line[:cut] + own[at:]))
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(300)] = rng.choice(words)
        texts.append("\n".join(copy[rng.randint(0, 200):]))
    texts += [" ".join(base + base), "long " * 2 + " ".join(rng.choices(words, k=20000)), "z" * 50000]
    return texts


@pytest.mark.parametrize("often", [substrings.OFTEN, 3])
def test_passages_match_brute_force(spark, monkeypatch, often):
    """With spread seeds (3) and boundary windows that are sent to all tasks, and without."""
    monkeypatch.setattr(substrings, "OFTEN", often)
    monkeypatch.setattr(substrings, "SALTS", 4)
    monkeypatch.setattr(substrings, "FREQUENT", 1 << 16 if often == 3 else 4)
    rows = list(enumerate(passages()))
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("doc", "mark", "spans", "n_words", "place")}).repartition(6)
    got = substrings.remove(df, kept="kept").collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_passages(sorted(rows))
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got)


def test_passages_of_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (-5, text), (7, "x y"), (7, text + " end"), (7, text + " end"), (8, "x y")]
    got = substrings.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed) for r in got)
    assert found == [(False, 0, 30, 0), (True, -5, 30, 30), (True, 7, 2, 0), (True, 7, 31, 30),
                     (True, 7, 31, 30), (True, 8, 2, 0)]
    same = spark.createDataFrame([(1, text)] * 3, "doc_id long, text string")
    assert [r.n_removed for r in substrings.remove(same).collect()] == [0, 0, 0]
    assert substrings.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_seeds_are_a_function_of_the_window():
    words = substrings.mix(np.arange(500, dtype=np.uint64) % np.uint64(60))
    place = substrings.minimizers(words)
    for i in range(0, len(place) - 60):
        assert place[i + 60] == place[i] + 60 and i <= place[i] <= i + substrings.EDGE
