"""Training corpus from raw documents: each stage's rows are the next stage's input.

Documents rated poor go; boilerplate lines go (equal texts stay equal, for the next
stage to drop); one document of each group of near duplicates stays (that with the
smallest id); documents that hold a passage of the benchmark go; what is left is packed
into sequences. A stage sees whatever its predecessor kept, and all stages but the last
return the columns of documents, with n_chars up to date.

Defined results: null and empty texts pass or go like any other (they have no lines, no
near copies and no passages; the classifier rates them); rows without an id are not
linked; repeated rows are near copies of each other, of one id all stay; columns beside
those of documents pass through as they are, whatever their names; no rows, no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alarmloom.llm import decontamination, line_dedup, ngram_join, packing, quality
from alarmloom.llm.catalog import table, vocabulary
from alarmloom.llm.shared import written


def _aside(docs: DataFrame, *used: str) -> DataFrame:
    """The used columns, and all others in one, where no result can take their names."""
    others = [c for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(F.lit(0).alias("__none"), *others).alias("__rest"))


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs again; those that stand beside the others count."""
    return rows.select(
        *[F.col(c) if c in rows.columns and c not in rows.schema["__rest"].dataType.names
          else F.col("__rest")[c].alias(c) for c in docs.columns]
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected quality is good enough."""
    # the model learns from the documents as they were
    raw, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = quality.train(raw, quality.graded(labels))
    rated = quality.rate_with(model, _aside(docs, "doc_id", "text"))
    return _restored(rated.where("kept"), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less boilerplate lines."""
    cleaned = line_dedup.line_dedup(_aside(docs, "doc_id", "text", "source", "n_chars"))
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
    return _restored(cleaned.withColumn("n_chars", F.coalesce(n_chars, "n_chars")), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    found = ngram_join.ngram_join(docs.select("doc_id", "text"))
    away = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(away, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = table(spark, sf_dir, "benchmark")
    searched = decontamination.decontaminate(_aside(docs, "doc_id", "text"), items)
    return _restored(searched.where(~F.col("contaminated")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.best_fit_packing(docs, vocabulary("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

ORACLE_SQL = None  # neither the classifier nor the tokenizer can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
