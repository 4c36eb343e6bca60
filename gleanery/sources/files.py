"""File sources and sinks: binary scans, tolerant decoding, chat exports, blob store, JSON lines, run log."""

from __future__ import annotations

import codecs
import fnmatch
import mimetypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.functions.content import deep_urls, part_assets, part_types, parts_text
from gleanery.functions.text import epoch_iso


def scan(spark: SparkSession, path: str, include: str | None = None, exclude: str | None = None, every: bool = False) -> DataFrame:
    """path, mime, bytes, checksum, modified_ts, content of the regular files below ``path``.  Spark's listing passes over
    files without a byte, and over names (of folders too) that begin with a dot or an underscore; ``every`` adds those.
    They are found by a listing of file states on the driver and read by the executors, which must be able to open the
    path themselves: a mounted folder, or a store that pyarrow knows.  One that can't be opened is left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
    if include:
        reader = reader.option("pathGlobFilter", include)
    d = reader.load(path).select("path", "length", "modificationTime", "content")
    if every:
        rows = [r for r in _passed_over(spark, path) if not include or fnmatch.fnmatch(r[0].rsplit("/", 1)[1], include)]
        rest = spark.createDataFrame(rows, "path string, length long, ms long").repartition(max(1, min(len(rows), spark.sparkContext.defaultParallelism)))
        rest = rest.mapInArrow(_with_content, "path string, length long, ms long, content binary").where("content is not null")
        d = d.union(rest.select("path", "length", F.timestamp_millis("ms"), "content"))
    if exclude:
        d = d.where(~F.col("path").rlike(exclude))
    known = F.create_map(*[F.lit(x) for e, m in sorted(mimetypes.types_map.items()) for x in (e, m)])
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return d.select("path", F.coalesce(F.try_element_at(known, ext), F.lit("application/octet-stream")).alias("mime"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("checksum"), F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("modified_ts"), "content")


def _passed_over(spark: SparkSession, root: str) -> list[tuple[str, int, int]]:
    """path, length and time of the files below ``root`` that Spark's listing leaves out."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    top = len(fs.makeQualified(p).toString().rstrip("/"))
    found, each = [], fs.listFiles(p, True)
    while each.hasNext():
        f = each.next()
        at, n = f.getPath().toString(), f.getLen()
        if n == 0 or any(map(_hidden, at[top:].split("/"))):
            found.append((at, n, f.getModificationTime()))
    return found


def _hidden(name: str) -> bool:
    """Whether Spark's listing leaves a file or folder of this name out."""
    if name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _with_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each path's content, a file at a time; null where it can't be opened."""
    from pyarrow import fs

    def read(path: str) -> bytes | None:
        try:
            if path.startswith("file:"):  # not every character that a file's name can have is one of a URI
                with open("/" + path[5:].lstrip("/"), "rb") as f:
                    return f.read()
            store, at = fs.FileSystem.from_uri(path)
            with store.open_input_stream(at) as f:
                return f.read()
        except (OSError, pa.ArrowInvalid):
            return None

    for b in batches:
        for i in range(b.num_rows):
            n = b.column(1)[i].as_py()
            data = b"" if n == 0 else read(b.column(0)[i].as_py())
            yield pa.record_batch([*b.slice(i, 1).columns, pa.array([data], pa.binary())], names=[*b.schema.names, "content"])


_C1 = re.compile(rb"[\x80-\x9f]")


def detect_charset(data: bytes) -> str:
    """By byte order mark, else by the first 100,000 bytes: UTF-8 where they are valid (a cut character at their end aside),
    UTF-16 where every second byte of a text of plain letters is zero, Windows-1252 where there are bytes that Latin-1 has
    only control characters for, else Latin-1."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")):
        if data.startswith(mark):
            return name
    head = data[:100_000]
    even, odd = head[::2], head[1::2]
    for zero, full, name in ((odd, even, "utf-16-le"), (even, odd, "utf-16-be")):
        if len(zero) > 1 and not any(zero) and all(full):
            return name
    try:
        codecs.getincrementaldecoder("utf-8")().decode(head)
        return "utf-8"
    except UnicodeDecodeError:
        return "cp1252" if _C1.search(head) else "latin-1"


def decode_bytes(data: bytes, charset: str | None = None) -> str:
    """What cannot be decoded is left out."""
    return data.decode(charset or detect_charset(data), "ignore")


def decoded(files: DataFrame, detect: Callable[[bytes], str] = detect_charset) -> DataFrame:
    """Adds charset and text (normalized); html has its scripts, styles and tags removed.  ``detect``: names the charset of
    a file's bytes, as Python knows it."""
    from gleanery.functions.text import html_to_text, norm_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [x.as_py() for x in b.column(b.num_columns - 1)]
            sets = [detect(x) if x is not None else None for x in data]
            yield pa.record_batch([*b.columns[:-1], pa.array(sets, pa.string()), pa.array([decode_bytes(x, c) if x is not None else None for x, c in zip(data, sets)], pa.string())], names=[*b.schema.names[:-1], "charset", "text"])

    names = [c for c in files.columns if c != "content"]
    shape = ", ".join(f"{n} {t}" for n, t in files.select(*names).dtypes)
    d = files.select(*names, "content").mapInArrow(run, f"{shape}, charset string, text string")
    html = F.lower("path").rlike(r"\.html?$") if "path" in names else F.lit(False)
    return d.withColumn("text", norm_text(F.when(html, html_to_text(F.col("text"))).otherwise(F.col("text"))))


def chat_pairs(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """text (``User: …\\nAssistant: …``) of JSON lines with user and assistant.  Strict: a bad line fails the read;
    else it is left out, and only a file without any good line fails."""
    raw = spark.read.schema("user string, assistant string, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    good = F.col("_corrupt_record").isNull() & F.col("user").isNotNull() & F.col("assistant").isNotNull()
    text = F.concat(F.lit("User: "), F.col("user"), F.lit("\nAssistant: "), F.col("assistant"))
    if strict:
        return raw.select(F.when(good, text).otherwise(F.raise_error(F.lit("bad chat pair"))).alias("text"))
    out = raw.where(good).select(text.alias("text"))
    if out.isEmpty():
        raise ValueError(f"no valid chat pair in {path}")
    return out


def in_file_order(df: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: 0, 1, ... in order of reading.  Two levels: a number within each partition and, by broadcast, how
    many rows come before that partition; one row a partition is gathered."""
    d = df.withColumn("_m", F.monotonically_increasing_id()).select("*", F.shiftright("_m", 33).alias("_p"), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("_k"))
    size = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    before = size.select("_p", F.coalesce(F.sum("_c").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    return d.join(F.broadcast(before), "_p").withColumn(name, (F.col("_k") + F.col("_b")).cast("long")).drop("_m", "_p", "_k", "_b")


def messages(spark: SparkSession, path: str) -> DataFrame:
    """message_index, content: of JSON lines each line's content, else of the ``messages`` of a JSON file.  Content that
    is no string counts as its JSON text; an index is a place in the order of reading."""
    if path.endswith(".jsonl"):
        return in_file_order(spark.read.schema("content string").json(path), "message_index").select("message_index", "content")
    d = spark.read.schema("messages array<struct<content:string>>").option("multiLine", "true").json(path)
    return d.select(F.posexplode("messages").alias("message_index", "m")).select(F.col("message_index").cast("long"), F.col("m.content").alias("content"))


CONVERSATION = "struct<conversation_id:string,id:string,title:string,mapping:map<string,variant>>"


def conversation_nodes(spark: SparkSession, path: str, null_text: str = "None", place: bool = False) -> DataFrame:
    """Nodes of conversation exports (files hold one object or an array).  A file that isn't JSON gives no node.

    conv_id (conversation_id, id or title; else a digest of the file's path and the place in it), title, node_id,
    parent_id, children, create_time, create_time_iso, role, author_name, recipient, end_turn, status, type, part_types, text,
    assets, urls (of every string anywhere in the node), raw_content (JSON).  ``null_text`` is what a part's null text counts as.
    ``place`` adds file and nth (the conversation's place in it), so that rows can be put in the order of the files' paths.
    """
    raw = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True).select("value", F.input_file_name().alias("file"))
    many = F.from_json("value", f"array<{CONVERSATION}>")
    one = F.array(F.from_json("value", CONVERSATION))
    c = raw.select("file", F.posexplode(F.when(F.ltrim("value").startswith("["), many).otherwise(one)).alias("at", "c")).where("c.mapping is not null")
    blank = lambda x: F.nullif(x, F.lit(""))
    conv_id = F.coalesce(blank(F.col("c.conversation_id")), blank(F.col("c.id")), blank(F.col("c.title")), F.sha2(F.concat_ws("|", "file", F.col("at").cast("string")), 256))
    where = ["file", "nth"] if place else []
    n = c.withColumn("nth", F.col("at").cast("long")).select(*where, conv_id.alias("conv_id"), F.coalesce("c.title", F.lit("(untitled)")).alias("title"), F.explode("c.mapping").alias("node_id", "n"))
    get = lambda path, kind="string": F.try_variant_get("n", f"$.{path}", kind)
    m = "message"
    n = n.select(
        *where, "conv_id", "title", "node_id", get("parent").alias("parent_id"), F.coalesce(get("children", "array<string>"), F.array().cast("array<string>")).alias("children"), get(f"{m}.create_time", "double").alias("create_time"), get(f"{m}.author.role").alias("role"), get(f"{m}.author.name").alias("author_name"),
        get(f"{m}.recipient").alias("recipient"), get(f"{m}.end_turn", "boolean").alias("end_turn"), get(f"{m}.status").alias("status"), get(f"{m}.content.content_type").alias("type"),
        F.coalesce(get(f"{m}.content.parts", "array<variant>"), F.array().cast("array<variant>")).alias("parts"), get(f"{m}.content", "variant").alias("content"), F.to_json("n").alias("node"),
    )
    return n.select(
        *where, "conv_id", "title", "node_id", "parent_id", "children", "create_time", epoch_iso(F.col("create_time")).alias("create_time_iso"), "role", "author_name", "recipient", "end_turn", "status", "type",
        part_types(F.col("type"), F.col("parts")).alias("part_types"), parts_text(F.col("type"), F.col("parts"), null_text).alias("text"), part_assets(F.col("parts")).alias("assets"), deep_urls(F.col("node")).alias("urls"), F.to_json("content").alias("raw_content"),
    )


def write_parquet(df: DataFrame, path: str, schema: str) -> None:
    """Replace a catalog table.  The schema is stated, so an empty table is valid, too."""
    shape = df.sparkSession.createDataFrame([], schema).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in shape]).write.mode("overwrite").parquet(path)


def write_placeholder(spark: SparkSession, path: str, schema: str) -> None:
    """An empty table of that schema, unless something is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        spark.createDataFrame([], schema).write.parquet(path)


def write_card(card: DataFrame, path: str) -> None:
    """The one-row dataset card as JSON text."""
    card.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_jsonl(df: DataFrame, path: str, nulls: bool = True) -> None:
    """Replace a folder of JSON lines; without ``nulls`` fields that are null are left out."""
    df.write.mode("overwrite").option("ignoreNullFields", str(not nulls).lower()).json(path)


def store_blobs(files: DataFrame, path: str) -> None:
    """Content-addressed: each checksum once, those already there are left alone.  Which file gives a checksum's content is
    settled by paths alone, so contents are not shuffled."""
    spark = files.sparkSession
    one = files.groupBy("checksum").agg(F.min("path").alias("path"))
    new = files.join(one, ["checksum", "path"], "left_semi").select("checksum", "content")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        new = new.join(spark.read.parquet(path).select("checksum"), "checksum", "left_anti")
    new.withColumn("prefix", F.left("checksum", F.lit(2))).write.mode("append").option("compression", "zstd").partitionBy("prefix").parquet(path)


def write_zones(rows: DataFrame, root: str, kind: str = "docs") -> None:
    """Clean and quarantined rows under physically separate roots, by checksum prefix."""
    for z in ("silver_normalized", "red_quarantine"):
        rows.where(F.col("zone") == z).write.mode("overwrite").partitionBy("prefix").parquet(f"{root}/{z}/{kind}")


def log_run(spark: SparkSession, path: str, run_id: str, kind: str, params: dict, counts: dict | None = None, status: str = "ok") -> None:
    """Append one line to the run log; ``counts`` are a step's inputs and outputs (see ``counted``)."""
    import json

    row = (run_id, kind, json.dumps(params, sort_keys=True), json.dumps(counts, sort_keys=True) if counts else None, status)
    spark.createDataFrame([row], "run_id string, kind string, params string, counts string, status string").coalesce(1).write.mode("append").json(path)


def counted(df: DataFrame, name: str):
    """(df, observation): the rows are counted as an action passes them; no extra pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def list_files(spark: SparkSession, root: str, ending: str) -> list[str]:
    """Paths below ``root`` with that ending, hidden folders included (Spark's own listing leaves them out).  For a
    bounded set such as repository configurations."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    found, every = [], p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
    while every.hasNext():
        if (at := every.next().getPath().toString()).endswith(ending):
            found.append(at)
    return sorted(found)


def repositories(spark: SparkSession, root: str, remote: str | None = None) -> DataFrame:
    """source, dest, origin of the repositories below ``root``; with ``remote`` of those with a remote that contains it."""
    found = list_files(spark, root, "/.git/config")
    if not found:
        return spark.createDataFrame([], "source string, dest string, origin string")
    d = spark.read.text(found, wholetext=True).select(F.input_file_name().alias("path"), "value")
    d = d.withColumn("urls", F.regexp_extract_all("value", F.lit(r"(?m)^\s*url\s*=\s*(\S+)"), F.lit(1)))
    d = d.select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "urls", F.regexp_extract("value", r'(?s)\[remote "origin"\][^\[]*?\burl\s*=\s*(\S+)', 1).alias("origin"))
    if remote:
        d = d.where(F.exists("urls", lambda u: F.contains(u, F.lit(remote))))
    return repo_manifest(d.select("path")).join(d.select(F.regexp_extract("path", r"^(.*)/\.git/", 1).alias("source"), "origin"), "source").select("source", "dest", "origin")


def version_labels(lines: DataFrame) -> DataFrame:
    """label, version (array of numbers) of the lines (value) ``* Label: name`` that end in a dotted version."""
    label = F.regexp_extract("value", r"^\s*\*?\s*(?:Label:\s*)?(.*?)\s*$", 1)
    v = F.regexp_extract(label, r"(\d+(?:\.\d+)+|\d+)\s*$", 1)
    return lines.select(label.alias("label"), F.transform(F.split(v, r"\."), lambda x: F.try_to_number(x, F.lit("999999999")).cast("int")).alias("version")).where(F.col("label").rlike(r"\d\s*$"))


def repo_manifest(paths: DataFrame) -> DataFrame:
    """source, dest of every repository root among (path): the parent of a ``.git`` folder."""
    root = F.regexp_extract("path", r"^(.*)/\.git/", 1)
    d = paths.select(root.alias("source")).where("source <> ''").distinct()
    return d.select("source", F.concat(F.regexp_extract("source", r"([^/]*)$", 1), F.lit("_"), F.left(F.sha1(F.col("source").cast("binary")), F.lit(10))).alias("dest"))


def newest_version(labels: DataFrame) -> DataFrame:
    """The label with the largest dotted version at its end, compared number by number."""
    v = F.transform(F.split(F.regexp_extract("label", r"(\d+(?:\.\d+)*)\s*$", 1), r"\."), lambda x: F.try_to_number(x, F.lit("999999999")).cast("int"))
    return labels.withColumn("v", v).agg(F.max_by("label", "v").alias("label"))
