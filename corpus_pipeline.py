"""A corpus pipeline of five stages over the documents table.

Each stage reads what its predecessor wrote. The first two and the fourth drop
documents, the third drops lines, the last packs what is left.

All stages take null and repeated ids, null, empty and very long texts, repeated
rows and an empty table as their operators define them: a null text has no words
(quality rules reject it), rows of a null id are judged, kept and packed like
others, and equal rows share one verdict. Columns besides doc_id and text travel
in one column, so their names clash with nothing; but for ``n_chars``, which
follows the text, they are not changed. The last stage returns pieces only."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skydrift.llm import kk_packing, line_templates, quality_llr, queries, simhash_dedup, toxicity_chain
from skydrift.session import remove, scratch_path, temporaries
from skydrift.sources.tables import read_table

ORACLE_SQL = None  # hashed n-grams, fitted models and tokenizers are beyond SQL


def _plain(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, ``rest``, so that no name of
    theirs meets one of an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others or [F.lit(0)]).alias("rest"))


def _whole(plain: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return plain.select(*[F.col(c) if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in docs.columns])


ALL = ("doc_id", "text", "rest")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    judged = quality_llr.judge(_plain(docs), queries.trusted_ids(spark, sf_dir), keep=ALL)
    return _whole(judged.filter("kept"), docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain's last model doesn't call toxic."""
    scored = toxicity_chain.score(_plain(docs), queries.toxicity_labels(spark, sf_dir), queries.CATEGORIES, keep=ALL)
    return _whole(scored.filter(F.col("p_toxic") < toxicity_chain.THRESHOLD), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds too. Copies
    of a text lose the same lines, so that the next stage still knows them by it."""
    left = _whole(line_templates.drop_recurring(_plain(docs), copies_together=True), docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest id."""
    return _whole(simhash_dedup.first_of_each(_plain(docs), queries.SHINGLE_WORDS, queries.MAX_BITS), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences."""
    return kk_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage's are written and read again. What a
    stage has read and made on the way is removed when its rows are written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{number}")
        with temporaries(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
