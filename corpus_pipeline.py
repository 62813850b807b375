"""The training corpus from raw documents: what offends, repeats or leaks goes, the rest is packed.

Each stage takes what the one before it kept. All but the last return the columns of
``documents``; the last returns where every piece of every remaining text is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, lines, minhash, packing, toxicity
from tidemark.llm.graph import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: No SQL: the stages hold a trained model, edit distances and banded searches.
ORACLE_SQL = None


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose score reaches one half; the model knows the labels of all documents."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _documents(toxicity.score(_documents(docs), model).where("toxicity < 0.5"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without lines that stood in an earlier one or further up."""
    return _documents(lines.dedup_lines(_documents(docs)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one of the smallest id."""
    docs = _documents(docs)
    gone = minhash.near_duplicates(docs).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _documents(decontaminate.find_leaks(_documents(docs), benchmark).where(F.size("leaks") == 0))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each text goes."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_bins),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return STAGES[-1][1](spark, docs, sf_dir)
