"""A corpus from raw documents to token ids, one stage after the other.

Every stage but the last returns rows with the columns of its input. Language
identification and decontamination decide row by row and let rows pass in the scan;
near-duplicate removal names the rows that go by their place in the files (a table that
is no scan of Parquet is written first), so rows without a doc_id, or with the same one
and other texts, do not share a fate, and only those names meet the texts in a join.
What a stage writes for itself is deleted before it returns. Temporary columns are
prefixed, so a table may have further columns of any common name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polyad.llm import bpe, decontaminate, language, neardup, secrets
from polyad.llm.common import read, remainder
from polyad.session import release, stages
from polyad.sources.ordered import source_place

OWN = "_polyad_"
FILE, ROW, PRINT = OWN + "file", OWN + "row", OWN + "print"


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found go. Profiles are learned from the marks of the stage's own input."""
    return language.recognised(docs, language.profiles(docs.where(remainder("doc_id", 4) != 2)))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id stays, one without a doc_id only if no other has one.

    Rows that repeat both its doc_id and its text are the same document and stay with it.
    """
    with stages(spark) as inside:
        if source_place(docs) is None:
            docs = inside.keep(docs, "docs")
        file, row = source_place(docs)
        placed = docs.select("doc_id", "text", file.alias(FILE), row.alias(ROW), F.xxhash64(F.coalesce("text", F.lit(""))).alias(PRINT))
        members = neardup.near_duplicates(placed, carry=(FILE, ROW, PRINT)).select("doc_id", "component_key", FILE, ROW, PRINT)
        first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", PRINT, FILE, ROW)).alias("first")
        groups = members.groupBy("component_key").agg(F.count("*").alias("n"), first).where("n > 1").select("component_key", "first")
        same = f"{FILE} = first.{FILE} AND {ROW} = first.{ROW} OR coalesce(doc_id = first.doc_id AND {PRINT} = first.{PRINT}, false)"
        gone = inside.keep(members.join(groups, "component_key").where(f"NOT ({same})").select(FILE, ROW), "gone")
    file, row = source_place(docs)
    return docs.withColumns({OWN + "f": file, OWN + "r": row}).join(gone, (F.col(OWN + "f") == F.col(FILE)) & (F.col(OWN + "r") == F.col(ROW)), "left_anti").drop(OWN + "f", OWN + "r")


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage like a benchmark item go."""
    return decontaminate.without_copies(docs, read(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported secret is replaced by a mark, and the length is counted anew."""
    return secrets.hide(docs, F.col("source"), F.concat_ws("/", "source", "lang"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes that they decode to."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language identification", identify),
    ("near-duplicate removal", deduplicate),
    ("benchmark decontamination", drop_benchmark_copies),
    ("secret removal", hide_secrets),
    ("token encoding", encode),
]

#: Language ranks, edit alignments and byte-pair merges are beyond one SQL query; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result but the last's is written, and goes when the next one's is."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        with stages(spark) as inside:
            after = inside.keep(step(spark, docs, sf_dir), name.replace(" ", "_"))
        release(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
