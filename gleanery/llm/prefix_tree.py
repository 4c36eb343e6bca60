"""Chat formatting with a prefix tree.

Template: ``<|im_start|>role\\n text <|im_end|>\\n`` for every turn.  Inside role and text a backslash goes into every
``<|`` (and one more into ``<\\|``, ``<\\\\|`` ...), so that no control string is left and none is lost; line feeds and
backslashes of a role are escaped, too.

Conversations that begin with the same turns share those turns' tokens: they are emitted once, depth first.  A node (a
turn) has its place in its tree's token stream, the position ids of its tokens (they run along the path from the
root), and the intervals of the stream that its ancestors occupy, neighbouring ones joined: what its tokens attend to
besides themselves.

Scale: a conversation's path is the list of digests of its prefixes.  Equal conversations collapse first, with map-side
combine.  Sorting by path puts conversations with a common beginning next to each other, so each sorted range builds
its trees in one pass, with the open path as its only state (two turns are one if role and text are equal, whatever their digests); ranges are cut by sampled paths, so a first turn that a third
of all conversations share is spread over as many tasks as it takes (each range's tree repeats the shared turns once).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.batches import values
from gleanery.llm.common import checkpoint

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_ADD, _CUT = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ADD.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CUT.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Tokens:
    """Byte-level BPE ids; the two control strings have the two ids after the vocabulary and the one that is free."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.start, self.end = max(ranks.values()) + 2, max(ranks.values()) + 3

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids of a turn, and from where to where its text is."""
        head = [self.start, *self.bpe.encode_ordinary(escape_role(role) + "\n")]
        body = self.bpe.encode_ordinary(escape(text))
        return [*head, *body, self.end, *self.bpe.encode_ordinary("\n")], len(head), len(head) + len(body)

    def text(self, ids: list[int]) -> str:
        out, run = [], []
        for i in ids:
            if i >= self.start:
                out += [self.bpe.decode_bytes(run), START.encode() if i == self.start else END.encode()]
                run = []
            else:
                run.append(i)
        return b"".join([*out, self.bpe.decode_bytes(run)]).decode("utf-8", "surrogatepass")


_loaded: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path, leaf, turns: path has 8 bytes for each prefix, leaf 16 for the whole; turns in order of turn,
    rows with the same turn in order of role and text; null role and text are empty; null conv_id is one conversation."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    convs = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    convs = convs.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, leaves = b.column(0), [], []
            for roles, texts in zip(values(b.column(1)), values(b.column(2))):
                chain, path = b"", []
                for role, text in zip(roles, texts):
                    r = role.encode("utf-8", "surrogatepass")
                    chain = hashlib.sha256(chain + len(r).to_bytes(8, "big") + r + text.encode("utf-8", "surrogatepass")).digest()
                    path.append(chain[:8])
                keys.append(b"".join(path)), leaves.append(chain[:16])
            yield pa.record_batch([ids, pa.array(keys, pa.binary()), pa.array(leaves, pa.binary()), b.column(1), b.column(2)], names=["conv_id", "path", "leaf", "roles", "texts"])

    return convs.mapInArrow(run, "conv_id long, path binary, leaf binary, roles array<string>, texts array<string>")


NODE = "tree_id long, node long, parent long, depth int, token_ids array<int>, stream_start long, position_start long, ancestors array<struct<start:long,end:long>>, loss_from int, loss_to int, leaf binary"
_INTERVAL = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_SCHEMA = pa.schema([("tree_id", pa.int64()), ("node", pa.int64()), ("parent", pa.int64()), ("depth", pa.int32()), ("token_ids", pa.list_(pa.int32())), ("stream_start", pa.int64()), ("position_start", pa.int64()), ("ancestors", pa.list_(_INTERVAL)), ("loss_from", pa.int32()), ("loss_to", pa.int32()), ("leaf", pa.binary())])


def _grow(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = tokens(tokenizer).turn
        base = TaskContext.get().partitionId() << 32
        tree, stream, count = -1, 0, 0
        # key, node, stream end, position end, intervals up to and with it, role, text
        open_: list[tuple[bytes, int, int, int, list[tuple[int, int]], str, str]] = []
        for b in batches:
            rows = []
            for path, leaf, roles, texts in zip(*(values(b.column(i)) for i in range(4))):
                n = len(roles)
                shared = 0
                # keys only bring turns together; whether two are the same turn their role and text say
                while shared < min(n, len(open_)) and open_[shared][0] == path[8 * shared : 8 * shared + 8] and open_[shared][5:] == (roles[shared], texts[shared]):
                    shared += 1
                del open_[shared:]
                if not shared:
                    tree, stream, count = tree + 1, 0, 0
                for i in range(shared, n):
                    ids, lo, hi = turn(roles[i], texts[i])
                    above = open_[-1] if open_ else None
                    position = above[3] if above else 0
                    before = above[4] if above else []
                    loss = roles[i] == LOSS_ROLE
                    rows.append((base + tree, count, above[1] if above else None, i, ids, stream, position, [{"start": x, "end": y} for x, y in before], lo if loss else None, hi if loss else None, leaf if i == n - 1 else None))
                    end = stream + len(ids)
                    mine = [*before[:-1], (before[-1][0], end)] if before and before[-1][1] == stream else [*before, (stream, end)]
                    open_.append((path[8 * i : 8 * i + 8], count, end, position + len(ids), mine, roles[i], texts[i]))
                    stream, count = end, count + 1
                if shared == n and n:  # can't be: equal paths are one, and a prefix sorts before what it begins
                    raise ValueError("paths are not sorted or not distinct")
                if len(rows) > 2000:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    return run


def forest(conversations: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, leaves): nodes as in ``NODE``, one row a shared turn; leaves (conv_id, leaf): which node ends which conversation."""
    p = checkpoint(paths(conversations))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # of equal conversations one goes on: chosen by id alone, so that the texts of a much repeated one don't meet in a task
    first = p.groupBy("path", "leaf").agg(F.min("conv_id").alias("conv_id")).select(F.col("conv_id").alias("_first"), F.col("leaf").alias("_leaf"))
    distinct = p.join(first, F.col("conv_id").eqNullSafe(F.col("_first")) & (F.col("leaf") == F.col("_leaf")), "left_semi")
    ranged = distinct.select("path", "leaf", "roles", "texts").repartitionByRange(n, "path").sortWithinPartitions("path")
    return ranged.mapInArrow(_grow(tokenizer), NODE), p.select("conv_id", "leaf")


_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def read_back(nodes: DataFrame, tokenizer: str) -> DataFrame:
    """leaf, turns (array of role and text), loss (the texts under the mask), formatted_chars, from the nodes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokens(tokenizer)
        tree, path = None, []
        for b in batches:
            leaves, rows = [], []
            for tree_id, depth, ids, lo, hi, leaf in zip(*(values(b.column(i)) for i in range(6))):
                if tree_id != tree:
                    tree, path = tree_id, []
                del path[depth:]
                text = t.text(ids)
                path.append((text, unescape(t.text(ids[lo:hi])) if lo is not None else None))
                if leaf is not None:
                    whole = "".join(x for x, _ in path)
                    turns = [{"role": unescape_role(r), "text": unescape(x)} for r, x in _TURN.findall(whole)]
                    leaves.append(leaf), rows.append((turns, [x for _, x in path if x is not None], len(whole)))
                if len(rows) >= 256:
                    yield batch(leaves, rows)
                    leaves, rows = [], []
            if rows:
                yield batch(leaves, rows)

    def batch(leaves, rows):
        shape = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        return pa.record_batch([pa.array(leaves, pa.binary()), pa.array([r[0] for r in rows], shape), pa.array([r[1] for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.int64())], names=["leaf", "turns", "loss", "formatted_chars"])

    ordered = nodes.select("tree_id", "depth", "token_ids", "loss_from", "loss_to", "leaf", "node").repartition("tree_id").sortWithinPartitions("tree_id", "node")
    return ordered.drop("node").mapInArrow(run, "leaf binary, turns array<struct<role:string,text:string>>, loss array<string>, formatted_chars long")


def formatted_digests(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """One row a conversation, read back from the forest; see the contract.  An empty table gives an empty result."""
    nodes, leaves = forest(conversations, tokenizer)
    back = read_back(checkpoint(nodes), tokenizer)
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    out = back.select("leaf", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
    return leaves.join(out, "leaf").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
