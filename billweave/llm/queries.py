"""The operators' queries over the driver's tables: op1 to op13, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    cross_polytope,
    divergence,
    fingerprints,
    jaccard_join,
    language_model,
    line_dedup,
    packing,
    pii,
    piece_bpe,
    quality_rules,
    spelling,
    toxicity,
    url_filters,
)
from .common import read_table

# Rules of the url query: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_packing": op2_packing,
        "op3_fingerprints": lambda s, d: fingerprints.with_edits(read_table(s, d, "documents")),
        "op4_toxicity": op4_toxicity,
        "op5_url_filters": op5_url_filters,
        "op6_line_dedup": lambda s, d: line_dedup.dedup(read_table(s, d, "documents")),
        "op7_jaccard_join": lambda s, d: jaccard_join.join(read_table(s, d, "documents")),
        "op8_language_model": lambda s, d: language_model.score(read_table(s, d, "documents")),
        "op9_quality_rules": op9_quality_rules,
        "op10_piece_bpe": lambda s, d: piece_bpe.encode(
            read_table(s, d, "documents"), public_tokenizers.path("piece_bpe_32k.model")
        ),
        "op11_source_divergence": lambda s, d: divergence.audit(read_table(s, d, "documents")),
        "op12_spelling_variants": lambda s, d: spelling.group(read_table(s, d, "documents")),
        "op13_cross_polytope": lambda s, d: cross_polytope.nearest(
            read_table(s, d, "embeddings"), F.col("vec_id") % 20 == 0
        ),
    }


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(read_table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("found", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("found")).alias("spans"),
    )


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(read_table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic")
    return toxicity.score(docs, toxicity.train(docs, labels))


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(read_table(spark, folder, "pages"), rules)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, read_table(spark, folder, "labels"))
