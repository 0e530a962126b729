"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept, and is
written as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.linededup import drop_lines, line_bitmaps
from tidemark.llm.mixing import mixed_sample
from tidemark.llm.ngramjoin import drop_near_duplicates
from tidemark.llm.packing import subword_packing
from tidemark.llm.quality import quality_rules
from tidemark.llm.store import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, fixed and adaptive."""
    judged = quality_rules(docs, keep=docs.columns)
    return judged.where("kept").select("doc.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines found in ten documents or more."""
    return drop_lines(docs, line_bitmaps(docs, min_documents=10))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each group linked at 80 % of its five-word shingles."""
    return drop_near_duplicates(docs, size=5, percent=80)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens are mixed to the target weights.

    80 % of all in expectation, or the largest share at which all targets hold.
    """
    sample = mixed_sample(docs, share=0.8, keep=tuple(docs.columns), exact=True)
    return sample.where("sampled").select(*[F.col(f"doc.`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: one row per piece of a document with its bin and place."""
    return subword_packing(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Components of a similarity join and best-fit packing are not expressible in SQL; tests run the
# stages beside brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
