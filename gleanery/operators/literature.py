"""A literature catalog: scan, validation, grouping by tag, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.config import load_config

ITEM = "pos int, id string, title string, year int, type string, tags array<string>, url string, authors array<string>, venue string, notes string"
REQUIRED = ("id", "title", "year", "type", "tags")

# fixed values: the report's groups, each with the tags that belong to it
GROUPS = [
    ("Retrieval — sparse/dense/late", ["retrieval", "sparse", "dense", "late-interaction"]),
    ("Reranking", ["reranking"]),
    ("Fusion — RRF & score fusion", ["fusion"]),
    ("Expansion — RF/PRF/doc2query", ["expansion"]),
    ("Diversification — MMR", ["diversification"]),
    ("Evaluation — BEIR/MS MARCO", ["evaluation"]),
    ("Agentic RAG", ["agentic-rag"]),
    ("Foundations — textbooks/surveys", ["foundations"]),
    ("Production — Azure/hosted rerankers", ["production"]),
    ("Security — prompt/context injection", ["security"]),
]


def items(spark: SparkSession, found: list[dict]) -> DataFrame:
    """A catalog's items in order; keys that an item lacks are null."""
    names = [c.split()[0] for c in ITEM.split(", ")][1:]
    return spark.createDataFrame([(k, *(x.get(n) for n in names)) for k, x in enumerate(found)], ITEM)


def load_items(spark: SparkSession, path: str) -> DataFrame:
    return items(spark, load_config(path, spark).get("items", []))


def problems(catalog: DataFrame) -> DataFrame:
    """id, problem: a required key is missing, an id comes twice, or a URL isn't http(s).  A valid catalog has no row."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in REQUIRED]))
    bad_url = F.when(F.col("url").isNotNull() & ~F.col("url").rlike("^https?://"), F.array(F.lit("url"))).otherwise(F.array().cast("array<string>"))
    rows = catalog.select("id", F.explode(F.concat(missing, bad_url)).alias("problem"))
    twice = catalog.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit("id twice").alias("problem"))
    return rows.union(twice)


def by_group(catalog: DataFrame, groups: list[tuple[str, list[str]]] = GROUPS) -> DataFrame:
    """grp, title of the group, nth, and the item's columns: the items with a tag of the group, each once, ordered by the
    first such tag and then as in the catalog."""
    spark = catalog.sparkSession
    tags = spark.createDataFrame([(g, title, k, t) for g, (title, ts) in enumerate(groups) for k, t in enumerate(ts)], "grp int, group_title string, tag_pos int, tag string")
    hit = catalog.select("pos", "id", F.explode("tags").alias("tag")).join(F.broadcast(tags), "tag")
    first = hit.groupBy("grp", "group_title", "id").agg(F.min(F.struct("tag_pos", "pos")).alias("at"))
    nth = F.row_number().over(Window.partitionBy("grp").orderBy("at"))
    return first.withColumn("nth", nth).withColumn("pos", F.col("at.pos")).drop("at").join(catalog.drop("id"), "pos")


def pipe_escape(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def report(catalog: DataFrame, groups: list[tuple[str, list[str]]] = GROUPS) -> DataFrame:
    """grp, section: a Markdown table for each group, in order, also for those without an item."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    link = F.when(text("url") != "", F.concat(F.lit("[link]("), "url", F.lit(")"))).otherwise("")
    row = F.concat(F.lit("| "), pipe_escape(text("id")), F.lit(" | "), pipe_escape(text("title")), F.lit(" | "), text("year"), F.lit(" | "), text("type"), F.lit(" | "), link, F.lit(" |"))
    rows = by_group(catalog, groups).select("grp", "nth", row.alias("row")).groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("nth", "row"))).alias("rows"))
    every = catalog.sparkSession.createDataFrame([(g, t) for g, (t, _) in enumerate(groups)], "grp int, title string")
    table = F.concat(F.lit("| ID | Title | Year | Type | Link |\n|---|---|---:|---|---|\n"), F.array_join("rows.row", "\n"), F.lit("\n"))
    return every.join(rows, "grp", "left").select("grp", F.concat(F.lit("## "), "title", F.lit("\n\n"), F.when(F.col("rows").isNull(), F.lit("_(no entries yet)_\n")).otherwise(table)).alias("section"))
