"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, jaccard, linededup, packing, quality
from sluice.llm.common import apart, ready, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the thresholds of their language and source keep."""
    ready(spark)
    return quality.quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; a document of which nothing is left goes."""
    ready(spark)

    def shortened(part: DataFrame) -> DataFrame:
        out = linededup.dedup_lines(part).filter("n_removed = 0 or text <> ''")
        return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*part.columns)

    return apart(docs, ["doc_id", "text", "n_chars"], shortened)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies: five-word shingles, similarity 0.8 or more. Documents without an id stay, unless near one that has an
    id; of repeated rows one stays."""
    ready(spark)
    groups = written(jaccard.near_duplicates(docs.select("doc_id", "text"), k=5, percent=80), "groups")
    first = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_id"))
    repeated = first.count() > first.distinct().count()

    def one_of_each(part: DataFrame) -> DataFrame:
        kept = part.join(first.distinct(), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        return kept.dropDuplicates(["doc_id", "text"]) if repeated else kept

    return apart(docs, ["doc_id", "text"], one_of_each)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminated(docs, table(ready(spark), sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens: one row for each piece of a document."""
    import public_tokenizers

    ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot encode texts; the stages are tested against plain Python versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again as the next one's input."""
    docs = table(ready(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
