"""Token counts as delta-maintained rollups.

Totals are kept by source, language and tokenizer version and never recounted: a batch brings signed changes (an insert
counts +1 document, a delete -1, a revision -1 with the old counts and +1 with the new), which are summed per key with
map-side combine and added.  A batch is a folder of its own under ``deltas``; it counts once Spark's commit marker is
there, and a batch whose marker is there is not written again, so a repeated commit changes nothing and one that died
half-way is redone.  Every ``COMPACT`` batches are folded into a new snapshot, which holds the names of the batches it took in
until each has a marker of its own under ``done``; so no list grows with the number of batches, and a compaction
that died half-way is finished by the next call.

Revisions need the counts that were in before: the caller keeps them (``count_tokens`` gives a row a document), as a rollup
of sums can't.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.wordbpe import load

KEYS = ["source", "lang", "tokenizer_version"]
SUMS = ["n_docs", "n_chars", "n_tokens"]
COMPACT = 64
SHAPE = "source string, lang string, tokenizer_version string, n_docs long, n_chars long, n_tokens long"


def count_tokens(docs: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """doc_id, source, lang, tokenizer_version, n_chars, n_tokens for every row, from its whole text (null: empty).

    Null ids, sources and languages stay null; repeated rows are counted as often; other columns are left behind; an empty
    table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(tokenizer).encode
        for b in batches:
            texts = b.column(3)
            n = [len(encode(t)) for lo in range(0, b.num_rows, 512) for t in texts.slice(lo, 512).to_pylist()]
            chars = [len(t) for lo in range(0, b.num_rows, 512) for t in texts.slice(lo, 512).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(chars, pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "source", "lang", "n_chars", "n_tokens"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.mapInArrow(run, "doc_id long, source string, lang string, n_chars long, n_tokens long").withColumn("tokenizer_version", F.lit(version))


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), "n_chars", "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_chars")).alias("n_chars"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Of documents whose counts, source, language or tokenizer version changed."""
    return deletes(old).union(inserts(new))


class Rollup:
    """Totals under a folder.  One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = COMPACT):
        self.spark, self.path, self.every = spark, path.rstrip("/"), compact_every

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def _folders(self, kind: str) -> list[str]:
        """Names of the committed folders of ``deltas`` or ``snapshots``."""
        fs, p = self._fs(kind)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n for n in names if self._exists(f"{kind}/{n}/_SUCCESS"))

    @staticmethod
    def _name(batch_id: str) -> str:
        return hashlib.sha256(batch_id.encode()).hexdigest()[:32]

    def _snapshot(self) -> tuple[DataFrame | None, set[str]]:
        """The newest snapshot's totals, and the batches that it took in (``compact_every`` or so)."""
        found = self._folders("snapshots")
        if not found:
            return None, set()
        rows = self.spark.read.parquet(f"{self.path}/snapshots/{found[-1]}")
        held = {r[0] for r in rows.where("batch is not null").select("batch").collect()}
        return rows.where("batch is null").select(*KEYS, *SUMS), held

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False, without reading ``changes``, if it is already in.  A batch without rows is a batch, too."""
        name = self._name(batch_id)
        if self._exists(f"deltas/{name}/_SUCCESS") or self._exists(f"done/{name}") or name in self._snapshot()[1]:
            return False
        changes.groupBy(*KEYS).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS]).write.mode("overwrite").parquet(f"{self.path}/deltas/{name}")
        if len(self._folders("deltas")) >= self.every:
            self.compact()
        return True

    def totals(self) -> DataFrame:
        """Keys with at least one document or a sum that isn't zero.  Null source or language is a key of its own; without any
        batch there are no rows."""
        base, held = self._snapshot()
        paths = [f"{self.path}/deltas/{n}" for n in self._folders("deltas") if n not in held]
        every = self.spark.read.schema(SHAPE).parquet(*paths) if paths else self.spark.createDataFrame([], SHAPE)
        if base is not None:
            every = every.unionByName(base)
        return every.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where(" or ".join(f"{c} <> 0" for c in SUMS))

    def _settle(self) -> None:
        """Markers for the batches of the newest snapshot; then neither their folders nor older snapshots are needed."""
        for n in self._snapshot()[1]:
            fs, p = self._fs(f"done/{n}")
            fs.create(p, True).close()
            self._delete(f"deltas/{n}")
        for n in self._folders("snapshots")[:-1]:
            self._delete(f"snapshots/{n}")

    def compact(self) -> None:
        """Fold the batches into a new snapshot."""
        self._settle()
        names = self._folders("deltas")
        if not names:
            return
        ids = self.spark.createDataFrame([(n,) for n in names], "batch string")
        rows = self.totals().withColumn("batch", F.lit(None).cast("string")).unionByName(ids, allowMissingColumns=True)
        found = self._folders("snapshots")
        at = int(found[-1]) + 1 if found else 0
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshots/{at:012d}")
        self._settle()
