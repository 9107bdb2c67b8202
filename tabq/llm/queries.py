"""One query for each operator of this package, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tabq.llm import (
    align, bloomlm, bpe, chat, jaccard, langid, negatives, packing, pii, quality, statements, substrings,
    topk, toxicity)
from tabq.llm.common import fold, read


def op1_lm_scoring(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return bloomlm.score(docs, fold("doc_id", 5) == 1)


def op2_chat_format(spark, folder):
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                "conv_id long, turn int, role string, text string")
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(turns.union(own)))


def op3_ngram_jaccard_join(spark, folder):
    return jaccard.join(read(spark, folder, "documents"))


def op4_language_id(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.where(fold("doc_id", 5) != 0))
    rows = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text")
    return langid.predict(rows, model, keep=["doc_id", "held_out"])


def op5_exact_top_k(spark, folder):
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def op6_quality_rules(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    trusted = read(spark, folder, "labels").where(F.col("quality") == 1).select("doc_id")
    judged = quality.judge(docs, quality.learn(docs, trusted))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "score")


def op7_best_fit_packing(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op8_pii(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return pii.find(docs, pii.learn(docs), keep=["doc_id"])


def op9_toxicity(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    known = fold("doc_id", 3) != 1
    labels = read(spark, folder, "labels").select("doc_id", "toxic").where(known)
    model = toxicity.learn(docs.where(known), labels)
    rows = docs.select("doc_id", (~known).alias("held_out"), "text")
    return toxicity.predict(rows, model, keep=["doc_id", "held_out"])


def op10_byte_bpe(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = bpe.encode(docs, *vocabulary, keep=["doc_id"])
    return bpe.decode(ids, *vocabulary).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_cross_tokenizer_alignment(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return align.links(docs, public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"))


def op12_hard_negatives(spark, folder):
    vectors = read(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0, changed)


def op13_substring_dedup(spark, folder):
    return substrings.remove(read(spark, folder, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_chat_format": op2_chat_format,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_quality_rules": op6_quality_rules,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_substring_dedup": op13_substring_dedup,
}

#: SQL twins; the others cannot be said in SQL and are tested against brute force.
STATEMENTS = {"op2_chat_format": statements.OP2, "op5_exact_top_k": statements.OP5,
              "op12_hard_negatives": statements.OP12}
