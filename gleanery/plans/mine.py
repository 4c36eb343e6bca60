"""End-to-end jobs: mine a folder of files, and make training sets of a folder of chat exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.operators import chat, lake, mining
from gleanery.sources import files


def mine_dataset(spark: SparkSession, source: str, root: str, dataset_id: str, review_by: str, include: str | None = None, exclude: str | None = None) -> dict[str, int]:
    """Scan, store each content once, decode, chunk, score, route; write both catalogs, the texts of either zone under a
    root of its own, and the card.  Returns the counts of the run.

    Chunks are built within the row of their file, so documents need no shuffle to get their scores; an empty folder
    gives empty, valid tables.
    """
    found = files.scan(spark, source, include, exclude, every=True)
    files.store_blobs(found, f"{root}/bronze_raw")
    text = files.decoded(found)
    rows = mining.chunk_arrays(text.drop("content"))
    score = {k: F.coalesce(F.array_max(F.col(f"chunks.{k}_score")), F.lit(0.0)) for k in T.LEXICON}
    tags = F.when(F.coalesce("text", F.lit("")) == "", F.array(F.lit("non_text"))).otherwise(T.risk_tags(score))
    none = F.lit(None).cast("string")
    docs = rows.select(
        F.left("checksum", F.lit(24)).alias("doc_uid"), F.lit(dataset_id).alias("dataset_id"), F.col("path").alias("source_path"), "mime", "bytes", "checksum", F.col("modified_ts").alias("created_ts"), "modified_ts", none.alias("title"), none.alias("author"),
        F.lit("und").alias("lang"), "charset", F.size("chunks").cast("long").alias("chunk_count"), (F.size(tags) > 0).alias("quarantine"), *[v.alias(f"{k}_score") for k, v in score.items()], tags.alias("risk_tags"), "text", "chunks",
    )
    staged = f"{root}/_staged"
    docs.write.mode("overwrite").parquet(staged)  # scored once, read by each of the sinks
    docs = spark.read.parquet(staged)
    chunks = docs.select("doc_uid", "quarantine", F.posexplode("chunks").alias("idx", "c")).select(
        "doc_uid", F.concat("doc_uid", F.lit(":"), F.col("idx").cast("string")).alias("chunk_id"), F.col("idx").cast("long").alias("idx"), F.col("c.start").alias("offset_start"), F.col("c.end").alias("offset_end"), F.lit("und").alias("lang"),
        *[F.col(f"c.{k}_score").alias(f"{k}_score") for k in T.LEXICON], F.col("c.text").alias("text"), "quarantine",
    )
    files.write_parquet(docs, f"{root}/catalog/docs.parquet", lake.DOCS)
    files.write_parquet(chunks, f"{root}/catalog/chunks.parquet", lake.CHUNKS)
    zone = F.when(F.col("quarantine"), "red_quarantine").otherwise("silver_normalized")
    prefix = F.left("doc_uid", F.lit(2)).alias("prefix")
    files.write_zones(docs.select("doc_uid", "text", zone.alias("zone"), prefix), root, "docs")
    files.write_zones(chunks.select("doc_uid", "chunk_id", "text", zone.alias("zone"), prefix), root, "chunks")
    card = mining.card_of(docs, dataset_id, review_by)
    files.write_card(card, f"{root}/catalog/{dataset_id}.card")
    n = card.first()
    return {"quarantine_docs": n.quarantine_docs, "clean_docs": n.clean_docs}


def training_sets(spark: SparkSession, source: str, out: str, exchanges: int = 3) -> dict[str, int]:
    """Chat exports to sft, dpo_pairs and tool_traces as JSON lines; the ordered turns are written once and read by all
    three.  Returns the counts."""
    turns = chat.ordered_turns(files.conversation_nodes(spark, source))
    staged = f"{out}/_turns"
    turns.drop("assets", "part_types", "children").write.mode("overwrite").parquet(staged)
    turns = spark.read.parquet(staged)
    sets = {"sft": chat.sft_records(turns, exchanges), "dpo_pairs": chat.pair_records(turns), "tool_traces": chat.tool_traces(turns)}
    counts = {}
    for name, rows in sets.items():
        rows, seen = files.counted(rows, name)
        files.write_jsonl(rows, f"{out}/{name}", nulls=False)
        counts[name] = seen.get["rows"]
    return counts
