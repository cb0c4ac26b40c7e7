"""The thin queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe_codec, chain_dedup, cotrain, hilbert_shards, host_reputation, line_dedup, mcd_rules, notice_scan, oph_neardup, pq_neardup, prefix_trie, spelling_variants, swap_packing
from tillroll.llm.host_reputation import Rule
from tillroll.llm.store import table

TOKENIZER = "word_bpe_49k.json"


#: The longest rule that fits a url decides it.
RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]


def op1_pq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, dropped_lines for every document."""
    docs = table(spark, sf_dir, "documents")
    dropped = line_dedup.duplicate_lines(docs, threshold=2, least=20, least_equal=1)
    lines = docs.select("doc_id", line_dedup.row_key().alias("row"),
                        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"))
    return (lines.join(dropped, ["doc_id", "row"], "left")
            .select("doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped_lines")))


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.shards(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"], n_shards=16)


def op4_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return swap_packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_chain_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a passage that repeats words of a document with a smaller id."""
    return chain_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("row", "source_row")


def op7_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_oph_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oph_neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op9_mcd_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcd_rules.judge(table(spark, sf_dir, "documents"))


def op10_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge(table(spark, sf_dir, "pages"), RULES)


def op11_notice_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notice_scan.summary(notice_scan.scan(table(spark, sf_dir, "documents")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.misspelled_groups(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.branched_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pq_neardup, op2_line_dedup, op3_hilbert_shards, op4_swap_packing, op5_bpe_codec,
                                   op6_chain_dedup, op7_cotrain, op8_oph_neardup, op9_mcd_rules,
                                   op10_host_reputation, op11_notice_scan, op12_spelling_variants, op13_prefix_trie)} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_pq_neardup": pq_neardup.near_duplicates_sql(0.95), "op8_oph_neardup": oph_neardup.near_duplicates_sql(2, 80),
            "op10_host_reputation": host_reputation.judge_sql(RULES),
            "op12_spelling_variants": spelling_variants.misspelled_groups_sql(),
            "op13_prefix_trie": prefix_trie.branched_trie_sql()}
