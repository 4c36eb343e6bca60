"""Chat-export mining: trees to turns, content, segments, preference pairs, traces, search."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.functions.batches import values
from gleanery.functions.content import envelope

_FENCE = re.compile(r"```(?:\w+)?\n(.*?)```", re.S)


def tree_order(nodes: DataFrame) -> DataFrame:
    """conv_id, seq, node_id, parent_id, depth: depth-first order of (conv_id, node_id, parent_id, create_time).

    Roots have no parent.  Siblings go by time, a missing time last, then by id; a node is visited once; one
    whose parent doesn't exist is unreachable.  One conversation is one group; the walk is iterative, so depth is no
    matter.
    """

    def run(key, table):
        kids: dict = {}
        seen = set()
        for node, parent, at in zip(*(table.column(c).to_pylist() for c in ("node_id", "parent_id", "create_time"))):
            kids.setdefault(parent, []).append((1e300 if at is None else at, node))
        rows, todo = [], [(n, None, 0) for _, n in sorted(kids.get(None, []), reverse=True)]
        while todo:
            node, parent, depth = todo.pop()
            if node in seen:
                continue
            seen.add(node)
            rows.append((key[0].as_py(), len(rows), node, parent, depth))
            todo += [(n, node, depth + 1) for _, n in sorted(kids.get(node, []), reverse=True)]
        shape = pa.schema([("conv_id", pa.string()), ("seq", pa.int64()), ("node_id", pa.string()), ("parent_id", pa.string()), ("depth", pa.int64())])
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape) if rows else shape.empty_table()

    n = nodes.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("node_id").cast("string").alias("node_id"), F.col("parent_id").cast("string").alias("parent_id"), F.col("create_time").cast("double").alias("create_time"))
    return n.groupBy("conv_id").applyInArrow(run, "conv_id string, seq long, node_id string, parent_id string, depth long")


def classify_tools(turns: DataFrame) -> DataFrame:
    """Adds tool_call, tool_result, tool_name from role, recipient and author_name."""
    call = F.coalesce((F.col("role") == "assistant") & F.col("recipient").isNotNull() & (F.col("recipient") != "all"), F.lit(False))
    result = F.coalesce(F.col("role") == "tool", F.lit(False))
    name = F.when(call, F.col("recipient")).when(result, F.nullif(F.col("author_name"), F.lit("")))
    return turns.withColumns({"tool_call": call, "tool_result": result, "tool_name": name})


def content_text(parts: Column) -> Column:
    """Text of an array of (content_type, text) parts: those with text, joined by line feeds, stripped."""
    return T.strip(F.array_join(F.transform(F.filter(parts, lambda p: p["text"].isNotNull()), lambda p: p["text"]), "\n"))


def ordered_turns(nodes: DataFrame) -> DataFrame:
    """The nodes of exports (``sources.files.conversation_nodes``) in depth-first order with seq, depth and the tool
    columns.  A child that no node describes is a turn with null fields."""
    links = nodes.select("conv_id", F.explode("children").alias("node_id"), F.col("node_id").alias("parent_id")).union(nodes.where("parent_id is null").select("conv_id", "node_id", F.lit(None).cast("string")))
    order = tree_order(links.join(nodes.select("conv_id", "node_id", "create_time"), ["conv_id", "node_id"], "left")).select("conv_id", "seq", "node_id", "depth")
    return classify_tools(order.join(nodes.drop("children"), ["conv_id", "node_id"], "left"))


def sft_segments(turns: DataFrame, exchanges: int = 3, conv: str = "conv_id", seq: str = "turn") -> DataFrame:
    """conv_id, start_seq, end_seq, n_turns: from every user turn to the ``exchanges``-th assistant turn after it (or the
    conversation's end), at least two turns.  A turn with end_turn false is no exchange."""
    ends = F.coalesce(F.col("end_turn"), F.lit(True)) if "end_turn" in turns.columns else F.lit(True)
    w = Window.partitionBy(conv).orderBy(seq)
    d = turns.select(conv, seq, "role", F.when((F.col("role") == "assistant") & ends, 1).otherwise(0).alias("x"))
    d = d.withColumn("c", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = d.groupBy(conv).agg(F.max(seq).alias("last"))
    marks = d.where("x = 1").select(conv, F.col("c").alias("mark"), F.col(seq).alias("at"))
    s = d.where("role = 'user'").select(conv, F.col(seq).alias("start_seq"), (F.col("c") + exchanges).alias("mark"))
    s = s.join(marks, [conv, "mark"], "left").join(last, conv).select(conv, "start_seq", F.coalesce("at", "last").alias("end_seq"))
    return s.withColumn("n_turns", (F.col("end_seq") - F.col("start_seq") + 1).cast("long")).where("n_turns >= 2")


def preference_pairs(turns: DataFrame, lookahead: int = 6, conv: str = "conv_id", seq: str = "turn") -> DataFrame:
    """conv_id, rejected_seq, chosen_seq, prompt_end, signal, rejected, chosen.

    user_correction: the first correcting user turn within ``lookahead`` turns, not after an acknowledging one, then the
    next assistant reply within them.  apology_followup: an apologising reply and the next one.
    """
    w = Window.partitionBy(conv).orderBy(seq).rowsBetween(1, lookahead)
    # a conversation's texts ride along once a row; the six next turns carry flags, and the text of replies alone
    user = F.col("role") == "user"
    said = F.coalesce(F.col("text"), F.lit(""))
    nxt = F.struct(
        F.col(seq).alias("s"), (user & T.strip(said).rlike(T.CORRECTION)).alias("fix"), (user & T.strip(said).rlike(T.ACKNOWLEDGE)).alias("ack"),
        F.when((F.col("role") == "assistant") & (said != ""), said).alias("reply"),
    )
    d = turns.select(conv, F.col(seq).alias("i"), "role", said.alias("said"), F.collect_list(nxt).over(w).alias("nx")).where("role = 'assistant' and said <> ''")
    halt = F.filter("nx", lambda n: n["fix"] | n["ack"])
    d = d.withColumn("fix", F.get(halt, 0)).withColumn("next", F.get(F.filter("nx", lambda n: n["reply"].isNotNull()), 0))
    fixed = d.where("fix.fix").withColumn("next", F.get(F.filter("nx", lambda n: n["reply"].isNotNull() & (n["s"] > F.col("fix.s"))), 0))
    a = fixed.select(conv, "i", "next", F.col("fix.s").alias("prompt_end"), F.lit("user_correction").alias("signal"), "said")
    b = d.where(F.col("said").rlike(T.APOLOGY)).select(conv, "i", "next", F.col("i").alias("prompt_end"), F.lit("apology_followup").alias("signal"), "said")
    return a.union(b).where("next is not null").select(conv, F.col("i").alias("rejected_seq"), F.col("next.s").alias("chosen_seq"), "prompt_end", "signal", F.col("said").alias("rejected"), F.col("next.reply").alias("chosen"))


def _within(spans: DataFrame, turns: DataFrame, lo: str, hi: str, block: int = 32) -> DataFrame:
    """Every span (conv_id, lo, hi) with each turn (conv_id, seq) in it.  An equi-join on blocks of seq: a key holds at most
    ``block`` turns however long the conversation, and a span goes to the few blocks it touches."""
    s = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col(lo) / block), F.floor(F.col(hi) / block))))
    t = turns.withColumn("_b", F.floor(F.col("seq") / block))
    return s.join(t, ["conv_id", "_b"]).where(F.col("seq").between(F.col(lo), F.col(hi))).drop("_b")


def _enveloped(turns: DataFrame) -> DataFrame:
    """conv_id, seq, m, tool: the turn as a message (null for other roles), and whether it is a call or a result."""
    have = set(turns.columns)
    col = lambda c, kind: F.col(c) if c in have else F.lit(None).cast(kind)
    tool_call, tool_result = (F.coalesce(col(c, "boolean"), F.lit(False)) for c in ("tool_call", "tool_result"))
    m = envelope(F.col("role"), F.col("text"), tool_call, tool_result, col("tool_name", "string"), col("recipient", "string"), col("raw_content", "string"))
    return turns.select("conv_id", "seq", m.alias("m"), (tool_call | tool_result).alias("tool"))


def _in_order(m: str = "m") -> Column:
    """Messages by seq; what they hold need not be orderable."""
    by = F.array_sort(F.collect_list(F.struct("seq", m)), lambda a, b: F.when(a["seq"] < b["seq"], -1).when(a["seq"] > b["seq"], 1).otherwise(0))
    return F.transform(by, lambda x: x[m])


def sft_records(turns: DataFrame, exchanges: int = 3) -> DataFrame:
    """messages, meta (conv_id, start_seq, end_seq, has_tools): the segments of ``sft_segments`` as training records;
    ``turns`` is (conv_id, seq, role, text) and, if known, end_turn, the tool columns and raw_content."""
    spans = sft_segments(turns, exchanges, "conv_id", "seq").select("conv_id", "start_seq", "end_seq")
    got = _within(spans, _enveloped(turns), "start_seq", "end_seq").groupBy("conv_id", "start_seq", "end_seq").agg(_in_order().alias("messages"), F.bool_or("tool").alias("has_tools"))
    return got.select(F.filter("messages", lambda m: m.isNotNull()).alias("messages"), F.struct("conv_id", "start_seq", "end_seq", "has_tools").alias("meta"))


def pair_records(turns: DataFrame, lookahead: int = 6, before: int = 6) -> DataFrame:
    """prompt_messages, rejected, chosen, signals, meta (rejected_seq, chosen_seq, conv_id): the pairs of
    ``preference_pairs`` with their context, from ``before`` turns ahead of the rejected reply to the end of the prompt."""
    pairs = preference_pairs(turns, lookahead, "conv_id", "seq").withColumn("_lo", F.greatest(F.col("rejected_seq") - before, F.lit(0)))
    keys = ["conv_id", "rejected_seq", "chosen_seq", "prompt_end", "signal", "rejected", "chosen"]
    got = _within(pairs, _enveloped(turns), "_lo", "prompt_end").groupBy(*keys).agg(_in_order().alias("messages"))
    return got.select(
        F.filter("messages", lambda m: m.isNotNull()).alias("prompt_messages"), "rejected", "chosen", F.create_map("signal", F.lit(True)).alias("signals"), F.struct("rejected_seq", "chosen_seq", "conv_id").alias("meta")
    )


def flat_sft(turns: DataFrame, conv: str = "conv_id", seq: str = "turn") -> DataFrame:
    """One row a turn of a known role."""
    return turns.where(F.col("role").isin("system", "user", "assistant")).select(conv, F.col(seq).alias("seq"), F.to_json(F.struct(F.col("role"), F.coalesce("text", F.lit("")).alias("content"))).alias("message"))


def conversation_counts(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    return turns.groupBy(conv).agg(F.count(F.lit(1)).alias("n_messages"), F.count_if(F.col("role") == "tool").alias("n_tool"), F.count_if(F.col("role") == "user").alias("n_user"), F.count_if(F.col("role") == "assistant").alias("n_assistant"))


def search(turns: DataFrame, needle: str, fields: list[str]) -> DataFrame:
    """Turns that contain ``needle`` in one of the fields, whatever the case."""
    return turns.where(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lit(needle.lower())))


def find_conversations(convs: DataFrame, needle: str, conv: str = "conv_id") -> DataFrame:
    """Rows of conversations whose title or id contains ``needle``, whatever the case; a null is empty."""
    hit = F.lit(False)
    for c in ("title", conv):
        if c in convs.columns:
            hit = hit | F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(needle.lower()))
    return convs.where(hit)


def tool_traces(turns: DataFrame) -> DataFrame:
    """conv_id, seq, tool_name, direction, text_preview, urls, and where known payload and time, of calls and results."""
    d = classify_tools(turns).where("tool_call or tool_result")
    name = F.coalesce("tool_name", F.nullif(F.col("recipient"), F.lit("")), F.lit("tool"))
    more = [F.col(c).alias(n) for c, n in (("raw_content", "payload"), ("create_time_iso", "time")) if c in d.columns]
    links = F.col("urls") if "urls" in d.columns else T.urls(F.col("text"))
    return d.select("conv_id", "seq", name.alias("tool_name"), F.when(F.col("tool_call"), "call").otherwise("result").alias("direction"), F.left(F.coalesce("text", F.lit("")), F.lit(200)).alias("text_preview"), links.alias("urls"), *more)


def tree_text(turns: DataFrame) -> DataFrame:
    """conv_id, seq, line: two spaces a level."""
    return turns.select("conv_id", "seq", F.concat(F.repeat(F.lit("  "), F.col("depth").cast("int")), F.lit("└─ ["), F.col("role"), F.lit("] "), F.col("text")).alias("line"))


def code_spans(messages: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """id columns, start, end, code: fenced blocks with character offsets.  An info string that is no word doesn't open
    a block, its closing fence then does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(id_cols)
        for b in batches:
            at, spans = [], []
            for i, t in enumerate(values(b.column(k))):
                for m in _FENCE.finditer(t or ""):
                    at.append(i), spans.append((m.start(1), m.end(1), m[1]))
            pick = pa.array(at, pa.int64())
            yield pa.record_batch([*(b.column(i).take(pick) for i in range(k)), *(pa.array([s[j] for s in spans], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.string())))], names=[*id_cols, "start", "end", "code"])

    d = messages.select(*id_cols, text_col)
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.schema.fields[:-1])
    return d.mapInArrow(run, f"{shape}, start long, end long, code string")
