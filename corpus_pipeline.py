"""From raw documents to packed sequences: quality, language, near-duplicates, personal data, packing.

Each stage takes all that its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import fresh_name, settle, table
from meterline.llm.language import with_language
from meterline.llm.near_text import near_duplicates
from meterline.llm.packing import pack
from meterline.llm.pii import mask_pii
from meterline.llm.quality import THRESHOLD, with_quality
from meterline.session import configure

#: A document whose language is surer than this stays.
LEAST_SURE = 0.4


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1; without labels to learn from, all of them.

    A null text is judged as an empty one, a very long text whole, each of repeated rows for itself, a null id like any
    other; an empty table stays empty. Columns may have any names.
    """
    score = fresh_name(docs, "score")
    scored = with_quality(docs, table(spark, sf_dir, "labels"), score)
    return scored.filter(F.col(score) >= THRESHOLD).select(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told with some certainty.

    A null or empty text has no language and goes; a very long text is judged whole, each of repeated rows for itself, a
    null id like any other; a score that is no number would be no certainty. An empty table stays empty. Columns may
    have any names.
    """
    lang, sure = fresh_name(docs, "told"), fresh_name(docs, "sure")
    told = with_language(docs, lang, sure)
    certain = (F.col(sure) >= LEAST_SURE) & ~F.isnan(sure)
    return told.filter((F.col(lang) != "und") & certain).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts: the one with the smallest id, a null id coming last.

    Every row is a document of its own here, so rows that share an id stay if their texts are unlike, and repeated rows
    are copies of each other. Texts without words (null ones among them) are like no other; of those that share an
    id one row stays, and all that have no id stay. Very long texts are compared whole, an empty table stays empty.
    Columns may have any names.
    """
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    if repeated.isEmpty():  # an id names its row
        kept = settle(near_duplicates(docs).filter("kept").select("doc_id"), "kept")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    row = fresh_name(docs, "row")
    # Written once: rows keep their numbers, whichever task reads them again.
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    return rows.join(settle(first_rows(rows, row), "kept"), row, "left_semi").select(*docs.columns)


def first_rows(rows: DataFrame, row: str) -> DataFrame:
    """The numbers (row) of the rows that stay of each group."""
    groups = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    ids = rows.select(F.col(row).alias("row"), F.col("doc_id").alias("id"))
    found = groups.select(F.col("doc_id").alias("row"), "component_id", (F.col("n_shingles") > 0).alias("words")).join(ids, "row")
    group = F.when(F.col("words") | F.col("id").isNull(), F.col("component_id"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))["row"].alias(row)
    return found.groupBy(group.alias("group"), F.when(~F.col("words"), F.col("id")).alias("own")).agg(first).select(row)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and n_chars, where there is one, counted anew.

    A null text stays null (and its n_chars is null), an empty one empty; very long texts are searched whole, each of
    repeated rows for itself. Null ids and an empty table stay as they are. Columns may have any names.
    """
    masked = mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, with their ids and the checksum of these.

    A null text is an empty one, which has its end mark only; a very long text is cut into several pieces, each of
    repeated rows is packed for itself, a null id is kept, an empty table gives no rows. Other columns are not read.
    """
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_text", one_of_each),
    ("pii", without_pii),
    ("packing", packed),
]

#: Models and a recall target are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
