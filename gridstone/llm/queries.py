"""The queries ``opN_<name>`` over the whole tables, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats

    found = remove_repeats(_docs(spark, sf_dir), length=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .weighted_sampling import fingerprint_documents

    return fingerprint_documents(_docs(spark, sf_dir), samples=32)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_contamination

    found = find_contamination(_docs(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import KINDS, find_pii

    found = find_pii(_docs(spark, sf_dir).select("doc_id", "text"))
    named = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("pii", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"), F.array_join(F.transform("pii", named), ",").alias("spans"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_docs(spark, sf_dir), _byte_bpe(), capacity=1024, end_id=2)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(_docs(spark, sf_dir), _byte_bpe(), limit=1024)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    return shard_documents(_docs(spark, sf_dir), [1.0] * 24)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import held_out, score_quality, train

    docs = _docs(spark, sf_dir).select("doc_id", "text")
    scored = score_quality(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_join import near_classes

    return near_classes(_docs(spark, sf_dir), n=5, threshold=0.8)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses

    return scan_licenses(_docs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_fingerprints": op2_fingerprints,
        "op3_decontamination": op3_decontamination,
        "op4_pii": op4_pii,
        "op5_best_fit_packing": op5_best_fit_packing,
        "op6_token_counts": op6_token_counts,
        "op7_sharding": op7_sharding,
        "op8_quality_classifier": op8_quality_classifier,
        "op9_near_join": op9_near_join,
        "op10_license_scan": op10_license_scan,
    }


def oracle_sql() -> dict[str, str]:
    from .oracle import SQL

    return SQL
