"""From raw documents to packed sequences: each stage works on all that the one before kept.

Documents go by quality, lose their frequent lines, then one of each group of
near copies stays, leaked benchmark items take their documents out, and what is
left is packed. Stages between return the columns of ``documents``. A row
without ``doc_id`` is never taken out by a stage that decides by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namepulse.llm import decontam, jaccard, linededup, packing, quality
from namepulse.llm.queries import tokenizer_file
from namepulse.llm.tables import documents, settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REPEATED_IN = 10
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_rows(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; ``n_chars`` follows the text."""
    index = linededup.build(docs, least=REPEATED_IN)
    kept = linededup.drop_frequent(index, docs, ["doc_id", "lang", "source"])
    text = F.col("kept_text")
    return kept.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group stays, and so does every document without words."""
    groups = jaccard.link_groups(docs, size=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    copies = groups.where("component_id != doc_id").select("doc_id")
    return docs.select(*COLUMNS).join(copies, "doc_id", "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaked = decontam.leaks(docs, documents(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(leaked, "doc_id", "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_tokens(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("packing", packed),
]

#: No SQL: estimates, tokenizer ids and packing cannot be written in it. Tested stage by stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), f"stage-{number + 1}")
    return docs
