"""Small cases for every operator: nulls, empty texts, ties, repeated rows, empty tables, clashing
columns, and comparisons with brute force."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from tabq.llm import bloomlm, bpe, chat, jaccard, langid, packing, pii, quality, topk, toxicity  # noqa: E402
from tabq.llm.common import fold  # noqa: E402

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
TEXTS = [None, "", "  \n ", "a", "One two", "x " * 300, "ß é 中文 👍 \x00 ok", "Dup line\nDup line\nother",
         "word " * 3 + "#$ 12", "long" * 3000]


def table(spark, texts, extra=True):
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in ("score", "n_words", "ids", "lang_pred", "length")
                           }) if extra else df


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def sentences(seed, n, length=60):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=length)) for _ in range(n)]


# 1 language model -----------------------------------------------------------------------------------


def test_lm_matches_brute_force_counts(spark):
    df = table(spark, TEXTS + sentences(1, 40), extra=False)
    got = {(r.doc_id, r.n_tokens): r for r in bloomlm.score(df, fold("doc_id", 5) == 1).collect()}
    rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in df.collect()]
    train = Counter(w for i, ws in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in ws)
    n, v = sum(train.values()), len(train)
    for i, ws in rows:
        r = got[i, len(ws)]
        base = sum(np.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        assert (r.n_known, r.train_tokens) == (sum(train[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert bloomlm.score(empty(spark), fold("doc_id", 5) == 1).count() == 0


def test_lm_probabilities_sum_to_about_one(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(sentences(2, 400))],
                               "doc_id long, text string")
    n = 400 * 61
    model = bloomlm.learn(df, n, len(WORDS) + 1)
    ends = [w.encode() for w in WORDS]
    first = bloomlm.hashes([b"alpha"])
    keys = np.append(bloomlm.hashes(ends), bloomlm.END)
    pairs = np.concatenate([[first[0], k] for k in keys])
    each = model.log10(pairs, np.full(len(keys), 2))[1::2]
    assert (10.0 ** each).sum() == pytest.approx(1, abs=0.02)


def test_lm_counts_are_kept_in_narrow_parts():
    n = np.unique(np.concatenate((np.arange(1, 5000), 2 ** np.arange(1, 35), 3 ** np.arange(1, 20))))
    for order, width in ((1, 1 / 64), (2, 1 / 8)):
        octave, part = bloomlm.codes(n, order)
        kept = bloomlm.values(order)[octave * bloomlm.PARTS[order] + part]
        assert (abs(kept - n) <= n * width).all()
        assert (kept == n)[n < 2 * bloomlm.PARTS[order]].all()
    assert bloomlm.values(1)[0] == 0


def zipfian(seed, texts, length, vocabulary):
    """Texts of many rare and some frequent words, each frequent one with words it prefers."""
    rng = np.random.default_rng(seed)
    made = []
    for _ in range(texts):
        w = (vocabulary ** rng.random(length)).astype(int)
        follows = np.flatnonzero((w[:-1] < 40) & (rng.random(length - 1) < 0.5))
        w[follows + 1] = w[follows] * 7 + rng.integers(0, 3, len(follows))
        made.append(" ".join(f"w{x}" for x in w))
    return made


def test_lm_is_the_smoothed_model_of_the_exact_counts(spark):
    """Brute force over a vocabulary of thousands: sums of one after every kind of history, and scores
    near those of exact counts."""
    texts = zipfian(5, 300, 400, 40_000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = [(i, t.split() + [None]) for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1]
    word = Counter(w for _, ws in train for w in ws)
    pair = Counter(p for _, ws in train for p in zip([0, *ws], ws))
    n, v = sum(word.values()), len(word)
    assert v > 10_000
    held_out = fold("doc_id", 5) == 1
    model = bloomlm.learn(df.where(~held_out), n, v)
    vocabulary = np.append(bloomlm.hashes([w.encode() for w in word if w]), bloomlm.END)
    ranked = [w for w, _ in word.most_common() if w]
    for h in [*ranked[:20], *ranked[100:2000:190], ranked[-1], "never seen"]:
        first = np.full(len(vocabulary), bloomlm.hashes([h.encode()])[0])
        each = model.log10(np.stack((first, vocabulary), 1).reshape(-1), np.full(len(vocabulary), 2))[1::2]
        unknown = bloomlm.PRIOR * 0.5 / (n + 0.5 * (v + 1)) / (word[h] + bloomlm.PRIOR)
        assert (10.0 ** each).sum() + unknown == pytest.approx(1, abs=0.02), h
    history = Counter(word) + Counter({0: len(train)})
    for r in bloomlm.score(df, held_out).collect():
        ws = texts[r.doc_id].split() + [None]
        exact = [(min(pair[h, w], word[w]) + bloomlm.PRIOR * (word[w] + 0.5) / (n + 0.5 * (v + 1)))
                 / (history[h] + bloomlm.PRIOR) for h, w in zip([0, *ws], ws)]
        assert r.score == pytest.approx(np.log10(exact).sum(), rel=0.02)


def test_lm_does_not_probe_again_for_n_grams_of_earlier_chunks(spark, monkeypatch):
    texts = [(f"w{i % 300} v{i % 7} " * 3) for i in range(900)]
    model = bloomlm.learn(spark.createDataFrame([(t,) for t in texts], "text string"), 6300, 308)
    asked, probe = [], bloomlm.probe
    monkeypatch.setattr(bloomlm, "probe", lambda *a: asked.append(len(a[2])) or probe(*a))
    monkeypatch.setattr(bloomlm, "RUN", 100)
    chunks = [bloomlm.tokens([t.encode() for t in part])
              for part in (texts[:200], texts[100:500], ["w1 new words", *texts[:900]])]
    fresh = [bloomlm.Model(model.n, model.v, model.rate, model.probes, model.segments).log10(*c)
             for c in chunks]
    before, asked[:] = sum(asked), []
    assert all((model.log10(*c) == f).all() for c, f in zip(chunks, fresh))
    assert 0 < sum(asked) < 0.6 * before
    monkeypatch.setattr(bloomlm, "REMEMBERED", 50)
    few = bloomlm.Model(model.n, model.v, model.rate, model.probes, model.segments)
    assert all((few.log10(*c) == f).all() for c, f in zip(chunks, fresh))
    assert all(len(keys) <= 50 and (np.diff(keys.astype(object)) > 0).all()
               for keys, _ in few.remembered.values())


def test_lm_scores_are_the_same_by_a_filter_that_is_not_broadcast(spark, monkeypatch):
    texts = TEXTS + sentences(3, 60) + [" ".join(f"w{i}x{k}" for k in range(80)) for i in range(20)]
    df = table(spark, texts, extra=False).repartition(3)
    held_out = fold("doc_id", 5) == 1

    def scores():
        return sorted((tuple(r) for r in bloomlm.score(df, held_out).collect()),
                      key=lambda r: (r[0], r[2]))

    monkeypatch.setattr(bloomlm, "BITS", 4096)  # several segments for few tokens
    broadcast = scores()
    assert bloomlm.segments_of(broadcast[0][4]) > 3
    for most in (bloomlm.SEGMENT // 8, 0):  # one segment, none
        monkeypatch.setattr(bloomlm, "MOST_BYTES", most)
        for x, y in zip(scores(), broadcast, strict=True):
            assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-12)


def test_lm_few_training_texts_and_many_segments_give_the_same_scores(spark, monkeypatch):
    texts = TEXTS + sentences(3, 60) + [" ".join(f"w{i}x{k}" for k in range(80)) for i in range(20)]
    df = table(spark, texts, extra=False).repartition(3)
    held_out = F.col("doc_id") % 10 != 3  # so a segment is built in several places

    def scores():
        return sorted((tuple(r) for r in bloomlm.score(df, held_out).collect()),
                      key=lambda r: (r[0], r[2]))

    n = scores()[0][4]
    monkeypatch.setattr(bloomlm, "BITS", 150 * bloomlm.SEGMENT / (n * bloomlm.FEWEST_PROBES))
    monkeypatch.setattr(bloomlm, "MOST_BYTES", 256 << 20)
    broadcast = scores()
    assert bloomlm.segments_of(n) // 64 > 1 and sum(r[2] for r in broadcast) > 4 * n
    monkeypatch.setattr(bloomlm, "MOST_BYTES", 0)
    for x, y in zip(scores(), broadcast, strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-12)


def test_lm_a_filter_that_is_not_broadcast_takes_little_disk(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"word{i}" for i in range(5000)]
    weights = [1 / (i + 1) for i in range(5000)]
    texts = [" ".join(rng.choices(words, weights, k=500)) for _ in range(400)]
    df, files = table(spark, texts, extra=False), []

    def kept(store):
        def run(*a):
            made = store(*a)
            files.extend(made.inputFiles() if "h" not in made.columns else [])  # not the vocabulary
            return made
        return run

    for store in ("stored", "bucketed"):
        monkeypatch.setattr(bloomlm, store, kept(getattr(bloomlm, store, None)), raising=False)
    monkeypatch.setattr(bloomlm, "MOST_BYTES", 0)
    scored = bloomlm.score(df, fold("doc_id", 5) == 1)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    size = sum(os.path.getsize(re.sub("^file:/+", "/", f)) for f in files)
    assert 0 < size < 3 * 200_000  # bytes a token; of 4 before that are which word it is, and the filter
    assert "Bucketed: true" in plan  # so chunks are not shuffled
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


@pytest.mark.parametrize("top", [1, 9, 2 ** 35, 2 ** 64 - 1])
def test_lm_packed_numbers_come_back(top):
    for n in (0, 1, 2, 1000):
        x = np.sort(np.random.default_rng(n).integers(0, top, n, np.uint64, endpoint=True))
        assert (bloomlm.unpacked_sorted(bloomlm.packed_sorted(x)) == x).all()
        small = (x % np.uint64(70_000)).astype(np.int64)
        assert (bloomlm.unpacked(bloomlm.packed(small)) == small).all()
        assert len(bloomlm.packed_sorted(x)) <= 5 + 2 + n * (2 + max(0, np.log2(top / max(1, n))) + 1) / 8


# 2 chat ---------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    said = "\\### Assistant: </turn> ok"
    odd = [said, "####", "\\", "</turn>\n### user: x", "", None, "ß中👍\n", "a:b", "<", "\\\\"]
    rows = [(c, t, r, x) for c in (1, 2, None) for t, (r, x) in enumerate(
        itertools.product(["user", "assistant", "we:ird\\</turn>\n", None], odd))]
    rows += [(1, 0, "user", said)] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df.repartition(3))).collect()}
    for c in (1, 2, None):
        own = sorted(((t, r or "", x or "") for k, t, r, x in rows if k == c),
                     key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        turns = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256(turns.encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (
            len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# 3 similarity join ----------------------------------------------------------------------------------


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if x and 100 * len(x & y) >= 75 * len(x | y):
            root[find(j)] = find(i)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return sorted((d, len(sets[i]), min(least[find(i)])) for i, (d, _) in enumerate(rows))


def test_jaccard_join_matches_brute_force(spark):
    rng = random.Random(4)
    common = sentences(5, 1, 40)[0].split()
    texts = list(TEXTS)
    for base in sentences(6, 4, 200):
        for _ in range(25):
            w = base.split()
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(WORDS) + "x"
            texts.append(" ".join(w))
    for n in range(6, 16):  # small sets and their partners
        w = [f"s{i}" for i in range(n)]
        texts += [" ".join(w), " ".join(w[:-1]), " ".join(w + ["end"])]
    texts += [" ".join(common + [f"own{i}w{k}" for k in range(rng.randint(1, 20))]) for i in range(90)]
    df = table(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, jaccard.join(df.repartition(4)).collect())) == brute_components(rows)
    assert jaccard.join(empty(spark)).count() == 0


def test_jaccard_signatures_are_shared_by_every_linked_pair():
    rng = np.random.default_rng(7)
    levels = rng.integers(0, 60, jaccard.CELLS).astype(np.uint8)
    for _ in range(400):
        n = int(rng.integers(1, 200))
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        other = np.unique(np.concatenate((keys[rng.random(len(keys)) > rng.random() * 0.3],
                                          rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)))
                                          .astype(np.uint64))))
        if jaccard.similar(keys, other):
            x, _, bx = jaccard.signatures(keys, levels, 30)
            y, _, by = jaccard.signatures(other, levels, 30)
            bx, by = dict(zip(x.tolist(), bx)), dict(zip(y.tolist(), by))
            assert any(7 * min(bx[s], by[s]) >= 3 * (len(keys) + len(other)) for s in bx.keys() & by)


def test_jaccard_buckets_of_the_same_sets_become_one(spark):
    rows = [(1, 10, 8, 5), (1, 11, 9, 6), (2, 10, 8, 7), (2, 11, 9, 4), (2, 11, 9, 4),  # the same sets
            (3, 10, 8, 8), (3, 11, 9, 9), (3, 12, 9, 9),  # one more
            (4, 13, 8, 8)]  # alone
    found = jaccard._distinct_buckets(spark.createDataFrame(rows, "sig long, node long, n int, most int"))
    buckets = {}
    for r in found.collect():
        buckets.setdefault(r.sig, []).append((r.node, r.n, r.most))
    assert sorted(map(sorted, buckets.values())) == [
        [(10, 8, 7), (11, 9, 6)], [(10, 8, 8), (11, 9, 9), (12, 9, 9)]]


def test_jaccard_components_take_few_tasks(spark):
    """The driver keeps a record of each task. Stars took a round that changed nothing (130 tasks)."""
    rng = random.Random(12)
    chain = rng.sample(range(-500, 500), 300)
    links = [*zip(chain, chain[1:]), *zip(chain[1:], chain), *((1000 + k, 900) for k in range(50)), (7, 7)]
    stars = [(1000 + k, 900) for k in range(50)]

    def run(pairs, group):
        spark.sparkContext.setJobGroup(group, group)
        found = jaccard.components(spark.createDataFrame(pairs, "a long, b long"))
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        spark.sparkContext.setJobGroup("tests", "tests")
        return sorted(map(tuple, found.collect())), sum(tracker.getStageInfo(s).numCompletedTasks for s in stages)

    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, _ = run(links, "chain")
        assert found == sorted([(n, min(chain)) for n in set(chain) - {min(chain)}] + stars)
        found, of_stars = run(stars, "stars")  # no round
        assert found == stars
        assert of_stars < 60
        assert run([], "none")[0] == []
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_jaccard_parities_differ_in_no_more_places_than_the_sets():
    rng = np.random.default_rng(8)
    for n in (1, 7, 100, 700, 5000):
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for share in (0, 0.1, 0.6, 1):
            other = np.unique(np.concatenate((keys[rng.random(n) >= share], rng.integers(
                0, 1 << 63, int(share * n)).astype(np.uint64))))
            places = sum(int(x).bit_count() for x in (
                jaccard.parities(keys) ^ jaccard.parities(other)).view(np.uint64))
            assert places <= len(np.setxor1d(keys, other))


# 4 language -----------------------------------------------------------------------------------------


def test_language(spark):
    english = ["the cat sat on the mat and the dog ran", "this is what they thought of the thing"] * 9
    german = ["der hund lief und die katze schlief nicht", "das ist was sie gedacht haben mit ihm"] * 9
    rows = [(t, "en") for t in english] + [(t, "de") for t in german] + [(None, "en"), ("x", None)]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    df = table(spark, ["the dog sat on the thing", "die katze lief und der hund", None, "", "12 !?", "zzqqj"])
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert [got[i].lang_pred for i in range(5)] == ["en", "de", "und", "und", "und"]
    assert got[5].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.predict(empty(spark), model).count() == 0
    none = langid.learn(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}


# 5 top-k --------------------------------------------------------------------------------------------


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.4, (300, 8)))]
    rows += [(i, rows[3][1]) for i in range(300, 320)] + [(50, rows[50][1])]  # ties, a repeated row
    bad = [(400, None), (450, [1.0, None] + [0.0] * 6), (500, [float("nan")] * 8), (550, [float("inf")] * 8)]
    df = spark.createDataFrame(rows + bad + [(600, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = Counter(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect()))
    v = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    ids = np.array([r[0] for r in rows])
    want = Counter()
    for q in np.flatnonzero(ids % 50 == 0):
        s = v @ v[q]
        best = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        want.update((int(ids[q]), k + 1, int(ids[j]), int(s[j])) for k, j in enumerate(best))
    assert got == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# 6 quality ------------------------------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_quality_counts_match_brute_force(spark):
    texts = TEXTS + sentences(9, 5, 80) + ["a\tb\x0bc\x0cd\re\xa0f", "\n\na\n \na\n"]
    for r in quality.counts(table(spark, texts)).collect():
        assert tuple(r[c] for c in quality.COUNTS) == brute_counts(r.text)


def test_quality_verdicts(spark):
    good = sentences(10, 40, 80)
    junk = [" ".join(w + "***" for w in t.split()) for t in sentences(11, 20, 80)]
    df = spark.createDataFrame(list(enumerate(good + junk + [None, "short"])), "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    got = {r.doc_id: r for r in quality.judge(df, quality.learn(df, trusted)).collect()}
    assert all(got[i].kept for i in range(40)) and not any(got[i].kept for i in range(40, 62))
    assert got[60].score is None and got[61].base_failed
    same = quality.learn(df, trusted.limit(0), buckets=16)
    assert same == [0.0] * 16
    assert quality.judge(empty(spark), same).count() == 0


def test_quality_score_is_the_mean_log_ratio_of_its_ngrams(spark):
    """Brute force with a bucket for each n-gram (enough of them that none collide)."""
    texts = sentences(12, 30, 40) + [" ".join(reversed(t.split())) for t in sentences(13, 30, 40)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(30)] + [(3,), (None,), (999,)], "doc_id long")
    ratios = quality.learn(df, trusted, buckets=1 << 20)

    def grams(text):
        w = (text or "").split()
        ends = [x[-3:] for x in w]
        return [*zip(w), *zip(ends, ends[1:]), *zip(ends[-1:])]

    raw = Counter(g for t in texts for g in grams(t))
    target = Counter(g for t in texts[:30] for g in grams(t))
    n, n_target, s = sum(raw.values()), sum(target.values()), quality.SMOOTHING

    def ratio(g):
        share = raw[g] / n
        return np.log((target[g] + s * share) / (n_target + s) / share)

    for r in quality.score(df, ratios).collect():
        own = [ratio(g) for g in grams(r.text)]
        assert r.score == (pytest.approx(np.mean(own)) if own else None)


# 7 packing ------------------------------------------------------------------------------------------


def test_plan_uses_every_length_and_is_tight():
    rng = random.Random(12)
    for histogram in ({}, {2048: 3}, {1: 5000}, {1025: 9}, {700: 7, 1348: 7},
                      dict(Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(4000)))):
        made = packing.plan(histogram)
        used = Counter()
        for lengths, n in made:
            assert sum(lengths) <= 2048 and n > 0
            for x in lengths:
                used[x] += n
        assert used == Counter(histogram)
        total = sum(k * n for k, n in histogram.items())
        alone = sum(n for k, n in histogram.items() if k > 1024)
        assert sum(n for _, n in made) <= max(-(-total // 2048) * 1.02, alone) + 1


def test_nnls_finds_the_exact_mix():
    a = np.array([[1.0, 0, 2], [0, 1, 1], [3, 0, 0]])
    x = np.array([2.0, 0, 5])
    assert packing.nnls(a, a @ x) == pytest.approx(x)


def test_packing_places_all_pieces(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(JSON)
    texts = TEXTS + sentences(13, 30, 300) + ["<|endoftext|> is an id", "x y z " * 4000]
    texts += ["x <|endoftext|> y", "a<|endoftext|><|endoftext|>", "<|endoftext|" * 3]
    df = table(spark, texts)
    rows = packing.pack(packing.pieces(df, JSON, with_ids=True)).collect()
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        assert sum(n for _, n in places) <= 2048
        assert [o for o, _ in sorted(places)] == list(
            itertools.accumulate([n for _, n in sorted(places)], initial=0))[:-1]
    for i, text in enumerate(texts):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted(by[i], key=lambda r: r.piece)
        if i == 1:  # given twice
            own = own[:1]
        assert b"".join(bytes(r.ids) for r in own) == ids.tobytes()
        assert [r.length for r in own][1:] == [2048] * (len(own) - 1)
    assert packing.pack(packing.pieces(empty(spark), JSON)).count() == 0


# 8 personal data ------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(
                    int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10))
                    for i, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((k, *m.span()))
    return found


def test_base_spans_match_the_patterns():
    rng = random.Random(14)
    parts = ["a", "b.c", "@", ".", "-", "1", "23", "255", "256", "+", " ", "(", ")", "9807915762804490",
             "x@y.z", "1.2.3.4", "+1 (017) 555-7713", "é", "_", "\n"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_a_repeated_number_is_found_in_another_form(spark):
    rng = random.Random(15)
    texts = []
    for i in range(300):
        phone = f"+1 (555) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        texts.append(f"call {phone} or again {phone} but not room {rng.randint(1, 99)} of 2024")
    df = table(spark, texts + [None, ""])
    model = pii.learn(df)
    text = "call +1 (555) 321-7654 today and later 321-7654 but not room 12 of 2024"
    (base, spans), = pii.spans_of([text], model)
    assert base == brute_spans(text) and set(base) < set(spans)
    added, = set(spans) - set(base)
    assert text[added[1]:added[2]] == "321-7654" and added[0] == 3
    out = {r.doc_id: r for r in pii.find(df, model).collect()}
    assert out[300].spans == "" == out[301].spans and out[0].n_phone == 2
    clean = pii.redact(df, model)
    assert clean.columns == df.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[300] is None and texts[0].startswith("call <PHONE> or again <PHONE> but not room")
    assert pii.find(empty(spark), pii.learn(empty(spark))).count() == 0


@pytest.fixture(scope="module")
def field(spark):
    """A field learnt from texts that write numbers in groups, and repeat them; as many are no phones."""
    rng, texts = random.Random(16), []
    for i in range(300):
        part = f"{rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)}"
        texts.append(f"so later {part} or {part} then and later {part}")
        phone = f"+1 555 {rng.randint(200, 999)} {rng.randint(1000, 9999)}"
        host = ".".join(str(rng.randint(1, 9)) for _ in range(4))
        texts.append(f"call {phone} or again {phone} not rooms {rng.randint(1, 99)} {rng.randint(1, 99)} "
                     f"of 2024, on {host} and {host} version {rng.randint(1, 9)}.{rng.randint(1, 9)}")
    return pii.learn(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def added(text, model):
    (base, spans), = pii.spans_of([text], model)
    assert base == brute_spans(text) and set(base) <= set(spans)
    return [(pii.KINDS[k], text[s:e]) for k, s, e in sorted(set(spans) - set(base), key=lambda x: x[1])]


def test_grouped_numbers_share_potentials(field):
    text = "call +1 555 321 7654 today and later 555 321 7654 not rooms 12 17 of 2024"
    assert added(text, field) == [("phone", "555 321 7654")]
    assert added("later 555 321 7654 not rooms 12 17 of 2024", field) == []


def test_a_number_repeated_many_times_is_found_each_time(field):
    text = "call +1 555 321 7654 " + "and later 555 321 7654 " * 50
    assert added(text, field) == [("phone", "555 321 7654")] * 50
    late = "and later 555 321 7654 " * 50 + "call +1 555 321 7654"
    assert added(late, field) == [("phone", "555 321 7654")] * 50


def test_repeats_are_linked_as_a_star():
    for text in ("on 1.2.3.4 and 1.2.3.4, then 1.2.3.4", "321 7654 or 321 7654 or 3217654"):
        chain, skip = pii.edges_of(pii.tokens_of(text, pii.base_spans(text)))
        assert len(skip) == 2 + ("321 " in text) and len(dict((b, a) for a, b in skip)) == len(skip)


def test_marginals_are_exact_on_trees_and_settle():
    rng = np.random.default_rng(6)
    for _ in range(5):
        own = rng.normal(size=(6, pii.LABELS))
        edges = np.array([(rng.integers(0, i), i) for i in range(1, 6)])
        pair = rng.normal(size=(5, pii.LABELS, pii.LABELS))
        exact = np.zeros_like(own)
        for labels in itertools.product(range(pii.LABELS), repeat=6):
            weight = np.exp(own[range(6), labels].sum() + sum(
                pair[e, labels[a], labels[b]] for e, (a, b) in enumerate(edges)))
            exact[range(6), labels] += weight
        exact /= exact.sum(1, keepdims=True)
        assert np.allclose(pii.propagate(own, edges, pair), exact, atol=2e-3)


# 9 toxicity -----------------------------------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(16)
    texts = sentences(17, 900, 50)
    toxic = {i for i in range(900) if i % 6 == 0}
    texts = [t + " " + rng.choice(["you idiot!", "total MORON."]) if i in toxic else t
             for i, t in enumerate(texts)]
    df = table(spark, texts + [None])
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.learn(df, labels)
    got = {r.doc_id: r for r in toxicity.predict(df, model).collect()}
    assert [i for i in range(900) if got[i].predicted] == sorted(toxic)
    assert 0 <= got[900].score < 0.7
    none = toxicity.learn(df, labels.limit(0))
    assert {r.predicted for r in toxicity.predict(df, none).collect()} == {0}
    assert toxicity.predict(empty(spark), model).count() == 0


# 10 BPE ---------------------------------------------------------------------------------------------


def test_bpe_equals_the_library(spark):
    import tiktoken

    own = bpe.codec(MULTI, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks,
                                special_tokens={})
    rng = random.Random(18)
    parts = ["a", "b", "ab", "the", "in", "er", " ", "ß", "中", "👍", "==", "aaaa", "\x00"]
    texts = [x for x in TEXTS if x] + ["a" * 5001, "=" * 3000, "é" * 2000] + [
        "".join(rng.choices(rng.sample(parts, rng.randint(1, 13)), k=rng.choice([9, 90, 900])))
        for _ in range(400)]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == library.encode_ordinary(t)
    df = table(spark, TEXTS)
    rows = bpe.decode(bpe.encode(df, MULTI, public_tokenizers.PATTERN), MULTI,
                      public_tokenizers.PATTERN).collect()
    assert len(rows) == len(TEXTS) + 1
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert bpe.encode(empty(spark), MULTI, public_tokenizers.PATTERN).count() == 0


def test_bpe_joins_every_piece_up_the_tree():
    joined = []

    class Counted(bpe.Codec):
        def join(self, left, right):
            joined.append((left, right))
            return super().join(left, right)

    own = Counted(MULTI, public_tokenizers.PATTERN)
    text = "The quick brown fox. A second sentence of usual words!"
    pieces = {p.encode() for p in own.findall(text)}
    ids = own.encode(text)
    below = [p for p in pieces if len(p) > 1]
    assert len(joined) >= len(below) and all(p in own.subtrees for p in below)
    n = len(joined)
    assert own.encode(text) == ids and len(joined) == n  # results are remembered
    for token, rank in list(own.ranks.items())[:3000]:  # merges lead to each token
        assert own.reduce(token) == [rank]
    assert own.decode(np.frombuffer(ids, "<u4")) == text.encode()
    for n in range(70):  # any shape of the tree
        assert own.decode(np.arange(n, dtype="<u4") + 300) == b"".join(own.bytes[300:300 + n])


# pipeline -------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    good = sentences(19, 30, 120)
    junk = [" ".join(w + "***" for w in t.split()) for t in sentences(20, 8, 120)]
    texts = good + [good[0], good[1] + " more", good[2] + " mail me a@b.example"] + junk + [None, "short"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet")
    kept, folder = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns
        kept.write.parquet(f"{tmp_path}/{len(seen)}")
        kept = spark.read.parquet(f"{tmp_path}/{len(seen)}")
        seen.append({r.doc_id: r.text for r in kept.collect()})
    assert set(seen[0]) == set(seen[1]) == set(range(33))
    assert len(seen[2]) == 30  # three near copies go
    assert set(seen[3]) == set(seen[2])
    assert not any("a@b.example" in t for t in seen[3].values())
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == set(seen[3])


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    import corpus_pipeline

    clashes = ["kept", "__kept", "score", "n_words", "base_failed", "__row", "__lang", "__score"]
    good = sentences(19, 30, 120)
    texts = good + [good[0], good[1] + " more", None, "short"]
    rows = [(i if i % 5 else None, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.concat(F.lit(c + " "), F.length("text")) for c in clashes}).coalesce(3)
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        for r in kept.collect():
            assert all(r[c] == f"{c} {len(r.text)}" for c in clashes), name
    assert kept.count() == 30
    assert corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count() >= 30


def test_pipeline_numbers_rows_once(spark, tmp_path):
    """Numbers must not follow the split of the files, which may differ at a second read."""
    import corpus_pipeline
    from tabq.llm.common import numbered

    spark.range(5000).repartition(3).write.option("parquet.block.size", 4096).parquet(f"{tmp_path}/ids")
    found, size = [], "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    for most in ("2k", "128m"):
        spark.conf.set(size, most)
        table = spark.read.parquet(f"{tmp_path}/ids")
        found.append((table.rdd.getNumPartitions(), sorted(map(tuple, numbered(table, "row").collect()))))
    spark.conf.set(size, before)
    assert found[0][0] != found[1][0] and found[0][1] == found[1][1]
    assert len({row for _, row in found[0][1]}) == 5000

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(sentences(3, 6))], "doc_id long, text string")
    left = corpus_pipeline.near_copies(spark, docs.union(docs), "")
    assert "monotonically" not in left._jdf.queryExecution().optimizedPlan().toString()
    assert left.count() == 6


def test_pipeline_of_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"
                          ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# SQL twins ------------------------------------------------------------------------------------------


def test_sql_twins(spark):
    import pathlib

    from check import compare, connect
    from tabq.llm.queries import QUERIES, STATEMENTS

    folder = "/root/testdata/sf0.001"
    if not pathlib.Path(folder).exists():
        pytest.skip("no test tables")
    connection = connect(folder)
    for name, sql in STATEMENTS.items():
        assert compare(spark, connection, folder, name, QUERIES[name], sql) is None
