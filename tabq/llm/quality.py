"""Quality rules: counts per text and a log-likelihood ratio of hashed n-grams, native expressions only.

The ratio compares two multinomials over hashed n-grams (words, pairs of
neighbouring word ends): one of a trusted target, one of the raw corpus. A text's score is the mean over its
n-grams; the verdict compares it with a fixed threshold, so the same text always gets the same
verdict under the same tables. No text is moved: both tables are sums of at most `buckets` rows.

Defined results: a NULL or empty text has no words, counts of 0 and score NULL, and fails the base
rule. Equal rows get equal results, one each. An empty table gives no rows. Without trusted texts
both tables agree, scores are 0 and only the base rule decides. Clashing columns of the input are
replaced by those added here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabq.llm.common import WHITE

BUCKETS = 1 << 15
#: Trusted labelled rows that the target table is learned from, at most (the raw table uses all).
TARGET_DOCS = 20_000
#: Mean log ratio under which a text goes.
THRESHOLD = -0.6
SMOOTHING = 100  # n-grams of the raw corpus that are added to the target
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _pieces(text: Column) -> Column:
    """Words. Single replacements and a split at one character cost a third of a pattern's time."""
    for c in WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _hole(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the columns COUNTS."""
    whole = _hole(F.col(text))
    df = df.withColumn("__words", _pieces(whole))
    # a window is a 64-bit hash of three neighbours; only texts with a repeated one go on
    windows = F.when(F.size("__words") < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.arrays_zip(F.slice("__words", 1, F.size("__words") - 2).alias("a"),
                         F.slice("__words", 2, F.size("__words") - 2).alias("b"),
                         F.slice("__words", 3, F.size("__words") - 2).alias("c")),
            lambda w: F.xxhash64(w["a"], w["b"], w["c"])))
    df = df.withColumn("__windows", windows)
    placed = F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("__placed", placed)
    last = F.size("__placed") - 1
    twice = F.flatten(F.zip_with(
        F.slice("__placed", 1, last), F.slice("__placed", 2, last),
        lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])).otherwise(
            F.array().cast("array<int>"))))
    covered = F.array_distinct(F.flatten(F.transform(
        F.array_distinct(twice), lambda i: F.array(i, i + 1, i + 2))))
    df = df.withColumn("__lines", F.filter(
        F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != ""))
    plain = whole
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    return df.withColumns({
        "n_words": F.size("__words").cast("bigint"),
        "word_chars": F.length(F.array_join("__words", "")).cast("bigint"),
        "n_symbols": (F.length(whole) - F.length(plain)).cast("bigint"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
        "n_repeat_words": F.when(F.col("__placed").isNull(), F.lit(0)).otherwise(
            F.size(covered)).cast("bigint"),
    }).drop("__words", "__windows", "__placed", "__lines")


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")))


def _bucket(*parts: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def _grams(words: str, use) -> Column:
    """use(bucket parts) of each word and of each pair of neighbouring word ends, by word."""
    return F.zip_with(words, F.slice(words, 2, F.size(words)), use)


def _ends(a: Column, b: Column) -> tuple[Column, Column]:
    """The last characters of two neighbours: suffixes, punctuation, marks."""
    return F.substring(a, -3, 3), F.substring(b, -3, 3)


def _sums(df: DataFrame, text: str, buckets: int) -> DataFrame:
    words = df.select(_pieces(_hole(F.col(text))).alias("k"))
    both = words.select(F.explode(F.concat(
        F.transform("k", lambda a: _bucket(a, buckets=buckets)),
        _grams("k", lambda a, b: _bucket(*_ends(a, b), buckets=buckets)))).alias("bucket"))
    return both.groupBy("bucket").agg(F.count("*").alias("n"))


def learn(corpus: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id",
          buckets: int = BUCKETS, target_docs: int = TARGET_DOCS) -> list[float]:
    """The log ratio of each bucket. trusted: ids of trusted texts, of which the `target_docs` with
    the smallest hashes serve; the raw table counts the whole corpus. At most `buckets` rows reach
    the driver from each."""
    chosen = (trusted.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("__id")).distinct()
              .orderBy(F.xxhash64("__id"), "__id").limit(target_docs))
    target_texts = corpus.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(
        F.broadcast(chosen), "__id", "left_semi")
    target = {r.bucket: r.n for r in _sums(target_texts, "__text", buckets).collect()}
    if not target:
        return [0.0] * buckets
    raw = {r.bucket: r.n for r in _sums(corpus, text, buckets).collect()}
    n, n_target, ratios = sum(raw.values()), sum(target.values()), [0.0] * buckets
    for bucket, count in raw.items():
        share = count / n  # the target table is smoothed towards the raw one
        mixed = (target.get(bucket, 0) + SMOOTHING * share) / (n_target + SMOOTHING)
        ratios[bucket] = math.log(mixed / share)
    return ratios


def score(df: DataFrame, ratios: list[float], text: str = "text") -> DataFrame:
    """df with `score`: the mean log ratio over the text's n-grams."""
    buckets = len(ratios)
    # one text that folds to a constant array; as many literals would slow the planner down
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast("array<double>")

    def ratio(*parts):
        return F.element_at(table, _bucket(*parts, buckets=buckets) + 1)

    df = df.withColumn("__k", _pieces(_hole(F.col(text))))
    n = F.size("__k")
    total = F.aggregate(_grams("__k", lambda a, b: ratio(a) + ratio(*_ends(a, b))),
                        F.lit(0.0), lambda s, x: s + x)
    return df.withColumn("score", F.when(n > 0, total / (2 * n))).drop("__k")


def judge(df: DataFrame, ratios: list[float], text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """df with COUNTS, base_failed, score and kept."""
    df = score(counts(df, text), ratios, text)
    return df.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False)))
