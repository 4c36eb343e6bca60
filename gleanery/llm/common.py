"""What the training-data operators share: shared-folder checkpoints, column hygiene and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import graph
from gleanery.plans.save import checkpointed, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so that a lost executor costs a re-read and not a recomputation."""
    return checkpointed(df.sparkSession)(df)


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as a long, text with null as empty, and the named further columns; other columns are left behind,
    so that none of theirs can clash with ours."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def connected_components(edges: DataFrame) -> DataFrame:
    """``operators.graph.connected_components`` with lineage cut in the shared folder."""
    return graph.connected_components(edges, save=checkpoint)
