"""Registered queries of this package and their DuckDB oracles (where SQL can express them)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecare.llm import (binary_records, compression_rules, decontaminate, exact_dedup,
                           hard_negatives, jaccard_join, packing, periodic_runs, quality_cnn,
                           quotes, secrets, token_counts, toxicity)
from tablecare.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.members(table(spark, sf_dir, "documents"))


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_quote_linking(spark, sf_dir):
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op4_decontamination(spark, sf_dir):
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_binary_output(spark, sf_dir):
    return binary_records.write_and_read(table(spark, sf_dir, "documents"),
                                         tokenizer("byte_bpe_50k.json"))


def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.learn(docs, labels))


def op7_secrets(spark, sf_dir):
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op8_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_cnn.score(docs, quality_cnn.learn(docs, labels))


def op9_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"),
                                     tokenizer("piece_bpe_32k.model"))


def op10_jaccard_join(spark, sf_dir):
    return jaccard_join.link_components(table(spark, sf_dir, "documents"))


def op11_quality_rules(spark, sf_dir):
    return compression_rules.judge(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"),
                               relabel=hard_negatives.shifted_label(),
                               is_anchor=F.col("vec_id") % 100 == 0)


def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return periodic_runs.digest(periodic_runs.find_runs(docs, reorder=periodic_runs.seeded_periods))


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_packing, op3_quote_linking, op4_decontamination, op5_binary_output, op6_toxicity,
    op7_secrets, op8_quality, op9_token_counts, op10_jaccard_join, op11_quality_rules,
    op12_hard_negatives, op13_periodic_runs)}

ORACLE_SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        WINDOW same AS (PARTITION BY t)""",
    "op2_packing": packing.oracle(),
    "op10_jaccard_join": jaccard_join.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
