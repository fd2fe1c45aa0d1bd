"""A training-corpus pipeline over ``documents``: five stages, each one operator of llm/.

``STAGES`` lists (name, function) in order; each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and reads again for the next stage.
All but the last return the columns of documents; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleframe.llm.common import free_name, stage, table, unzipped, zipped
from candleframe.llm.jaccard_join import jaccard_components
from candleframe.llm.line_dedup import line_dedup
from candleframe.llm.packing import best_fit_pack
from candleframe.llm.quality import quality_rules
from candleframe.llm.suffix_dedup import suffix_dedup, valid_text

#: Near duplicates of this stage: five-word shingles, similarity of 0.8 or more.
WORDS, SIMILARITY = 5, (80, 100)
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _counted(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with ``n_chars`` recounted."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules or their host's verdict reject go."""
    return quality_rules(docs, keep_text=True).where("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents repeat are cut, but for one holder."""
    return _counted(line_dedup(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays.

    A NULL id comes after all others; of rows with one id, the first of the staged table
    stays. Rows are told apart by their place in it, so a row goes only with its own group.
    Documents without words are in no group and stay.
    """
    row = free_name(docs.columns, "_row")
    packed = stage(zipped(docs.withColumn(row, F.monotonically_increasing_id())), "numbered")
    classes = jaccard_components(packed.select(row, "text"), WORDS, SIMILARITY, doc_id=row, numbered=True)
    placed = stage(classes.select(F.col("doc_id").alias(row), F.col("component_id").alias("of")).join(
        packed.select(row, F.col("doc_id").alias("id")), row), "near-duplicates")
    first = placed.groupBy("of").agg(
        F.count("*").alias("n"), F.min(F.struct(F.col("id").isNull(), "id", row))[row].alias("first")).where("n > 1")
    gone = placed.join(first, "of").where(F.col(row) != F.col("first")).select(row)
    return unzipped(packed.join(gone, row, "left_anti")).select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that occur more than once are cut; split characters go whole."""
    return _counted(valid_text(suffix_dedup(docs)), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as token pieces in training sequences."""
    return best_fit_pack(docs.select("doc_id", "text"), TOKENIZER)


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", passages),
    ("packing", packing),
]

#: SQL expresses neither the tokenizer nor the packing; a brute-force version tests each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; the packed pieces."""
    out = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        out = stage(function(spark, out, sf_dir), name)
    return out
