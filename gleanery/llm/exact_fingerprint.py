"""Document fingerprints: canonical exact digest, built from DataFrame and SQL functions only.

Canonical form: NFKC, full case folding, NFKC again (folding can undo it), runs of white space to one space, trimmed.
The fingerprint is 128 bits of XXH64 under two seeds plus the canonical byte length, so equal texts (and texts that
differ only in what is folded) have equal fingerprints.  Where it matters that equal fingerprints mean equal texts,
bytes are compared: row by row for the likeness columns, and inside the buckets of ``copy_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import checkpoint, id_text
from gleanery.operators.joins import BROADCAST_ROWS

SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _icu(cls: str, method: str, x: Column) -> Column:
    return F.call_function("java_method", F.lit(f"com.ibm.icu.{cls}"), F.lit(method), x, F.lit(True))


def canonical(text: Column) -> Column:
    """The canonical form; null counts as empty.  ICU ships with Spark; both calls are static methods of it."""
    t = F.coalesce(text, F.lit(""))
    t = _icu("text.Normalizer", "compose", _icu("lang.UCharacter", "foldCase", _icu("text.Normalizer", "compose", t)))
    return F.trim(F.regexp_replace(t, SPACE, " "))


def wide_hash(canon: Column) -> Column:
    """40 hex digits: XXH64 under two seeds, and the low 32 bits of the byte length."""
    h = F.concat(F.lpad(F.hex(F.xxhash64(canon)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(0x5EED), canon)), 16, "0"), F.lpad(F.hex(F.octet_length(canon)), 8, "0"))
    return F.lower(h)


def fingerprint_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint."""
    return id_text(docs).withColumn("canon", canonical(F.col("text"))).select("doc_id", "text", wide_hash(F.col("canon")).alias("fingerprint"))


def copy_classes(docs: DataFrame) -> DataFrame:
    """c_fingerprint, c_canon, copy_of: a row for each class of two or more rows with the same canonical bytes, whose smallest
    doc_id is ``copy_of``.  c_canon is null unless its fingerprint has several classes.

    Buckets of one row need no look.  In the others the canonical texts are compared byte for byte: equal texts
    collapse before the shuffle (grouping with map-side combine, so a text that a third of all rows repeat is sent
    once a task), and a bucket that holds different texts gives each its own class.
    """
    sig = checkpoint(fingerprint_texts(docs).select("doc_id", "fingerprint"))
    multi = checkpoint(sig.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("fingerprint").alias("m")))
    if multi.count() <= BROADCAST_ROWS:  # then texts stay where they are until equal ones have collapsed
        multi = F.broadcast(multi)
    canon = id_text(docs).select("doc_id", canonical(F.col("text")).alias("canon")).withColumn("fingerprint", wide_hash(F.col("canon")))
    classes = canon.join(multi, F.col("fingerprint") == F.col("m"), "left_semi").groupBy("fingerprint", "canon").agg(F.min("doc_id").alias("copy_of"))
    # the bucket's classes are few: equal texts are one by now
    classes = classes.withColumn("k", F.count(F.lit(1)).over(Window.partitionBy("fingerprint")))
    return checkpoint(classes.select(F.col("fingerprint").alias("c_fingerprint"), F.when(F.col("k") > 1, F.col("canon")).alias("c_canon"), "copy_of"))


def with_copies(rows: DataFrame, classes: DataFrame, text: Column) -> DataFrame:
    """``rows`` (doc_id, fingerprint, ...) with copy_of; ``text`` is the text that was fingerprinted."""
    match = F.col("fingerprint") == F.col("c_fingerprint")
    if classes.where("c_canon is not null").isEmpty():
        classes = classes.drop("c_canon")
        if classes.count() <= BROADCAST_ROWS:
            classes = F.broadcast(classes)
    else:
        rows = rows.withColumn("_canon", canonical(text))
        match &= F.col("c_canon").isNull() | (F.col("c_canon") == F.col("_canon"))
    return rows.join(classes, match, "left").withColumn("copy_of", F.coalesce("copy_of", "doc_id")).drop("c_fingerprint", "c_canon", "_canon")


def copy_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, copy_of (the smallest doc_id with the same canonical bytes): one row per input row.

    Null text counts as empty.  A row with a null doc_id is a copy of the smallest id like any other; null if there is
    none.  Repeated rows are returned as often; an empty table gives an empty result.
    """
    return with_copies(fingerprint_texts(docs), copy_classes(docs), F.col("text")).select("doc_id", "fingerprint", "copy_of")


def _range_of(key: Column, marks: list[int]) -> Column:
    """How many of the sorted ``marks`` are smaller than ``key``, by binary search over one folded array literal."""
    if not marks:
        return F.lit(0)
    arr = F.split(F.lit(",".join(map(str, marks))), ",").cast("array<bigint>")
    mid = lambda a: ((a.lo + a.hi) / 2).cast("int")
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(marks).bit_length())),
        F.struct(F.lit(0).alias("lo"), F.lit(len(marks)).alias("hi")),
        lambda a, _: F.when(a.lo >= a.hi, a).when(F.get(arr, mid(a)) < key, F.struct((mid(a) + 1).alias("lo"), a.hi.alias("hi"))).otherwise(F.struct(a.lo.alias("lo"), mid(a).alias("hi"))),
    )
    return found.lo


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_fingerprint: next by descending doc_id, after the last the first.

    No global sort: ids are dealt into ranges by approximate quantiles, and a range's first row is also dealt, as a
    guest, to the range before it, where it sorts last.  So the successor is a window over a range alone; texts travel
    in that one shuffle, and all that is broadcast is two numbers a range.  Rows with the same doc_id follow each other
    in the order of their texts; a null doc_id comes last.
    """
    spark = docs.sparkSession
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = []
    if n > 1:
        marks = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), F.array(*[F.lit((i + 1) / n) for i in range(n - 1)]), 10 * n)).first()[0] or []
    marks = sorted(set(marks))
    # range 0 holds the largest ids
    r = (F.lit(len(marks)) - _range_of(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))), marks)).alias("r")
    base = fingerprint_texts(docs).select(r, "*")
    tops = docs.select(F.col("doc_id").cast("long").alias("doc_id")).select(r, "doc_id").groupBy("r").agg(F.max("doc_id").alias("top"))
    ring = Window.partitionBy(F.lit(0)).orderBy("r")  # one row a range
    last = F.last("r").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = tops.select(F.col("r").alias("r2"), "top", F.coalesce(F.lag("r").over(ring), last).alias("before"))
    guests = id_text(docs).select(r, "doc_id", "text").join(F.broadcast(tops), (F.col("r") == F.col("r2")) & F.col("doc_id").eqNullSafe(F.col("top")))
    guests = guests.groupBy("before").agg(F.min("text").alias("text")).select(F.col("before").alias("r"), F.lit(None).cast("long").alias("doc_id"), "text", wide_hash(canonical(F.col("text"))).alias("fingerprint"), F.lit(True).alias("guest"))
    w = Window.partitionBy("r").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    rows = base.select("r", "doc_id", "text", "fingerprint", F.lit(False).alias("guest")).union(guests)
    rows = rows.withColumn("nx", F.lead(F.struct("text", "fingerprint")).over(w)).where(~F.col("guest"))
    return rows.select("doc_id", "text", "fingerprint", F.col("nx.text").alias("next_text"), F.col("nx.fingerprint").alias("next_fingerprint"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """The contract's row for every document, and copy_of (see ``copy_groups``); equal hashes count as alike only if the
    canonical bytes are equal.

    Null text counts as empty, and so is the edited text of an empty one.  Rows that repeat an id, or have none, are edited
    by the row that follows them (see ``with_next``), repeated rows are returned as often, and an empty table gives an
    empty result.
    """
    d = with_next(docs)
    n = F.length("text").cast("long")
    d = d.withColumn("n_chars", n).withColumn("edited", F.concat(F.expr("left(text, cast(n_chars as int) - cast(floor(n_chars / 2) as int))"), F.expr("left(next_text, cast(floor(n_chars / 2) as int))")))
    d = d.withColumn("edited_canon", canonical(F.col("edited"))).withColumn("edited_fingerprint", wide_hash(F.col("edited_canon")))
    same = lambda print_, other: F.when(F.col("fingerprint") == print_, F.when(canonical(F.col("text")) == other, 1.0).otherwise(0.0)).otherwise(0.0)
    d = d.withColumns({"near_edited": same(F.col("edited_fingerprint"), F.col("edited_canon")), "near_next": same(F.col("next_fingerprint"), canonical(F.col("next_text")))})
    d = with_copies(d, copy_classes(docs), F.col("text"))
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next", "copy_of")
