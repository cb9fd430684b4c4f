"""From documents to packed training sequences: language ID, line dedup, MinHash near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.llm import langid
from tenderlens.llm.common import cut_lineage, table
from tenderlens.llm.line_dedup import line_dedup
from tenderlens.llm.minhash import near_duplicates
from tenderlens.llm.pack import pack

#: Languages whose sizes differ by less than this share of the smaller one are too close to call.
LEAST_MARGIN = 0.002


def _packed(docs: DataFrame) -> DataFrame:
    """Id, text and, in one column, the whole row, so that no name of a column can meet one of an operator's."""
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("packed")
    return docs.select("doc_id", "text", row)


def _unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The rows again, with ``new`` values of some columns."""
    return df.select(*[new.get(c, F.col("packed")[f"c{i}"]).alias(c) for i, c in enumerate(columns)])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those too close to call; fill in a missing language.

    Without any labelled text no language is known; then nothing is rejected. Repeated rows are judged alike.
    """
    dictionaries = langid.learn(docs, "doc_id", "text", "lang")
    if not dictionaries:
        return docs
    out = langid.identify(_packed(docs), dictionaries, min_margin=LEAST_MARGIN, keep=["packed"], text_col="text")
    lang = F.coalesce(F.col("packed")[f"c{docs.columns.index('lang')}"], F.col("lang_pred"))
    return _unpacked(out.where(~F.col("rejected")), docs.columns, lang=lang)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the first document that has them. Every row stays; its text may become empty."""
    out = line_dedup(_packed(docs))
    return _unpacked(out, docs.columns, text=F.col("kept_text"), n_chars=F.char_length("kept_text").cast("long"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at similarity 0.8 or more stays: the smallest id.

    Rows that repeat an id are judged by their own texts; of rows with one id and one text a single one stays. Rows without
    an id stay.
    """
    kept = near_duplicates(docs, percent=80, with_tag=True).where("kept and doc_id is not null").select("doc_id", "tag").distinct()
    rows = _packed(docs).where("doc_id is not null").withColumn("tag", F.xxhash64("text"))
    # repeats go within each task first; the join then finds the rows dealt as it needs them
    rows = rows.drop("text").dropDuplicates(["doc_id", "tag"]).join(kept, ["doc_id", "tag"], "left_semi")
    return _unpacked(rows, docs.columns).unionByName(docs.where("doc_id is null"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their place in a sequence."""
    return pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("pack", pack_stage),
]
#: Language ID and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
