"""Benchmark decontamination by template canonicalisation.

Words are white-space separated chunks without their outer punctuation, lower-cased (ASCII and Latin-1).  Typed placeholders replace
numbers (NUM), units after a number (UNIT) and names (NAME: a title-case word that does not open a sentence; a run of
them is one name).  Windows of ``WINDOW`` template words are hashed and hash-joined with those of the benchmark items,
so a question whose numbers or names were exchanged still matches; a window needs half its words literal.  One with
more slots is hashed with the values as they stand (``slot_heavy``, which the query and the pipeline ask for) and counts only
towards an occurrence that has the item's own values throughout.

Matches of a document with an item on one diagonal (document position minus item position) are one occurrence.  It
counts if its windows cover ``NEED`` words (or all but one of a shorter item) and its slots are consistent: every
value of the item stands for one value in the document and the other way round.

Scale: documents are read once and only their windows that seem to hit the benchmark leave Python.  The hit test is a
Bloom filter of a fixed size (``FILTER_BITS``, 8 MB) whatever the benchmark's; a larger benchmark only lets more windows
through to the join, which is exact.  An occurrence's aggregate is bounded by the item's length; no list of a document's
or an item's matches is built.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.batches import parts
from gleanery.llm.bytewords import SPACE, bounds, hashes
from gleanery.llm.common import checkpoint, id_text
from gleanery.operators.joins import by_keys

WINDOW = 8
NEED = 13
FILTER_BITS = 26  # as a power of two
FILTER_HASHES = 2
SLAB = 100_000  # characters that are worked on at once
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t ton tons tonne tonnes lb lbs oz pound pounds ounce ounces ml cl dl l liter liters litre litres gal gallon gallons"
    " s sec second seconds min minute minutes h hr hrs hour hours day days week weeks month months year years mph kmh km/h m/s hz khz mhz ghz w kw mw kwh j kj cal kcal v kv a ma k °c °f c f pa kpa bar psi"
    " % percent usd eur gbp dollar dollars euro euros cent cents b kb mb gb tb bit bits byte bytes".split()
)
NUM, UNIT, NAME = 8, 16, 32
NUM_HASH, UNIT_HASH, NAME_HASH = (xxhash.xxh64_intdigest(x) for x in (b"\0NUM", b"\0UNIT", b"\0NAME"))
_PLAIN = str.maketrans("€£«»“”„‘’…–—·•  ", "$$" + '"' * 5 + "''.--**  ")
_ODD = re.compile("[€£«»“”„‘’…–—·•  ]").search


def _set(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_OUTER, _STOP, _LATE, _DIGIT, _NUMERIC = _set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), _set('.!?:;"'), _set(".!?"), _set("0123456789"), _set("0123456789.,:/-'")
_PROPER = ~(_OUTER | SPACE)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _word_hash(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(hashes(b, np.array([0]), np.array([len(b)]))[0])


_UNITS = np.sort(np.array([_word_hash(u) for u in UNITS], np.uint64))


def template(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every template word of all the texts: its hash (a placeholder's for a slot), the hash of what stands there,
    the slot's type or 0, and which text it is of."""
    parts = [(t if t.isascii() or not _ODD(t) else t.translate(_PLAIN)).encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.cumsum([0, *(len(x) + 1 for x in parts)])[:-1]
    raw = np.frombuffer(b" ".join(parts), np.uint8)
    b = _FOLD[raw]
    if (raw == 0xC3).any():  # capitals of Latin-1: C3 80-9E to C3 A0-BE, without the multiplication sign
        late = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)) + 1
        b[late] += 32
    starts, ends = bounds(b)
    n = len(starts)
    proper = _PROPER[b]
    inner = np.flatnonzero(proper)  # where words proper are
    before = np.concatenate(([0], np.cumsum(proper, dtype=np.int64)))
    opens = np.ones(n, bool)
    if n > 1:
        last = ends[:-1] - 1
        opens[1:] = _STOP[b[last]] | (_LATE[b[np.maximum(last - 1, 0)]] & (last > starts[:-1]))
    first, last = before[starts], before[ends]
    full = first < last
    opens, first, last = opens[full], first[full], last[full]
    if not len(first):
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint8), np.empty(0, np.int64)
    starts, ends = inner[first], inner[last - 1] + 1
    of = np.searchsorted(offsets, starts, "right") - 1
    same = np.zeros(len(of), bool)
    same[1:] = of[1:] == of[:-1]
    opens |= ~same
    value = hashes(b, starts, ends)
    kind = np.zeros(len(value), np.uint8)
    upper = b != raw
    wide = raw[starts] == 0xC3
    top = len(b) - 1
    title = upper[np.minimum(starts + wide, top)] & ~opens
    if title.any():
        second = np.minimum(starts + 1 + wide, top)
        small = (b[second] >= 97) & (b[second] <= 122) & ~upper[second] | (raw[second] == 0xC3) & ~upper[np.minimum(second + 1, top)] | (raw[second] > 0xC3)
        kind[title & small & (starts + 1 + wide < ends)] = NAME
    number = _DIGIT[b[starts]]
    if number.any():
        other = np.concatenate(([0], np.cumsum(~_NUMERIC[b])))
        number &= other[ends] == other[starts]
        kind[number] = NUM
        after = np.flatnonzero(number[:-1] & same[1:]) + 1
        place = np.minimum(np.searchsorted(_UNITS, value[after]), len(_UNITS) - 1)
        kind[after[_UNITS[place] == value[after]]] = UNIT
    name = kind == NAME
    again = np.zeros(len(name), bool)
    again[1:] = name[1:] & name[:-1]
    again &= same
    if again.any():
        head = np.flatnonzero(~again)
        nth = np.arange(len(value)) - np.repeat(head, np.diff(np.append(head, len(value))))
        value = np.add.reduceat(value * (2 * nth.astype(np.uint64) + np.uint64(1)), head)
        kind, of = kind[head], of[head]
    literal = value
    if kind.any():
        literal = value.copy()
        for k, h in ((NUM, NUM_HASH), (UNIT, UNIT_HASH), (NAME, NAME_HASH)):
            literal[kind == k] = h
    return literal, value, kind, of


def windows(literal: np.ndarray, value: np.ndarray, kind: np.ndarray, of: np.ndarray, size: int, slot_heavy: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window, and whether it lies in one text.  One with under half its words literal is left out, or its hash
    is that of the values, apart from the others."""
    n = len(literal) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)

    def hashed(words: np.ndarray, start: int) -> np.ndarray:
        h = np.full(n, start, np.uint64)
        for i in range(size):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += words[i : i + n]
        h ^= h >> np.uint64(31)
        return h

    h = hashed(literal, size)
    ok = of[:n] == of[size - 1 :]
    if kind.any():
        slots = np.concatenate(([0], np.cumsum(kind != 0)))
        heavy = 2 * (slots[size:] - slots[:-size]) > size
        if not slot_heavy:
            ok &= ~heavy
        elif heavy.any():
            h[heavy] = hashed(value, size + 64)[heavy]
    return h, ok


ROWS = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("hash", pa.int64()), ("pos", pa.int64()), ("size", pa.int64()), ("n_words", pa.int64()), ("slots", pa.list_(pa.int64()))])


def _slots(value: np.ndarray, kind: np.ndarray, at: int, size: int) -> list[int]:
    """Pairs of place in the window * 64 + type, and value."""
    where = np.flatnonzero(kind[at : at + size]) + at
    return [x for w in where.tolist() for x in ((w - at) * 64 + int(kind[w]), int(value[w].astype(np.int64)))]


def bloom(hashes: DataFrame) -> np.ndarray:
    """Words of the Bloom filter of a column of hashes: set bits meet per word before they are gathered, at most 2^20 words."""
    bit = lambda i: F.shiftrightunsigned(hashes.columns[0], i * (64 - FILTER_BITS)).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bits = hashes.select(F.explode(F.array(*[bit(i) for i in range(FILTER_HASHES)])).alias("bit"))
    rows = bits.groupBy(F.shiftrightunsigned("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def in_bloom(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for i in range(FILTER_HASHES):
        bit = h >> np.uint64(i * (64 - FILTER_BITS)) & np.uint64((1 << FILTER_BITS) - 1)
        ok &= (words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return ok


def _windows(sizes: list[int] | None, known, slot_heavy: bool):
    """sizes: the windows to take of every text; None: one size a text, that of an item.  known: broadcast Bloom filter or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        held = known.value if known is not None else None

        def rows_of(docs: list, texts: list[str]) -> Iterator[tuple]:
            literal, value, kind, of = template(texts)
            begin = np.searchsorted(of, np.arange(len(texts) + 1))
            for size in sizes or range(1, WINDOW + 1):
                h, ok = windows(literal, value, kind, of, size, slot_heavy)
                if sizes is None:  # of an item: windows of WINDOW words, or the whole
                    ok &= np.minimum(np.diff(begin), WINDOW)[of[: len(ok)]] == size
                if held is not None:
                    ok &= in_bloom(held, h)
                at = np.flatnonzero(ok)
                for i in at.tolist():
                    d = int(of[i])
                    yield docs[d], xxhash.xxh64_intdigest(texts[d]) - (1 << 63), int(h[i].astype(np.int64)), i - int(begin[d]), size, int(begin[d + 1] - begin[d]), _slots(value, kind, i, size)

        def full(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), ROWS)], schema=ROWS)

        for b in (p for whole in batches for p in parts(whole)):
            docs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            lo, size, rows = 0, 0, []
            for i, t in enumerate(texts):
                size += len(t)
                if size < SLAB and i + 1 < len(texts):
                    continue
                for row in rows_of(docs[lo : i + 1], texts[lo : i + 1]):
                    rows.append(row)
                    if len(rows) >= 20_000:
                        yield full(rows)
                        rows = []
                lo, size = i + 1, 0
            if rows:
                yield full(rows)

    return run


SHAPE = "doc_id long, row long, hash long, pos long, size long, n_words long, slots array<long>"


def occurrences(docs: DataFrame, benchmark: DataFrame, need: int = NEED, slot_heavy: bool = False) -> DataFrame:
    """doc_id, row, item_id, at, covered, item_words, verbatim: every occurrence that counts (see the module)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    items = checkpoint(items.mapInArrow(_windows(None, None, slot_heavy), SHAPE).select(F.col("doc_id").alias("item_id"), "hash", F.col("pos").alias("item_pos"), "size", F.col("n_words").alias("item_words"), F.col("slots").alias("item_slots")).distinct())
    sizes = [r[0] for r in items.select("size").distinct().limit(WINDOW).collect()]
    if not sizes:
        sizes = [WINDOW]
    known = spark.sparkContext.broadcast(bloom(items.select("hash")))
    hits = id_text(docs).mapInArrow(_windows(sorted(sizes), known, slot_heavy), SHAPE).select("doc_id", "row", "hash", "pos", "slots")
    pairs = hits.join(items, "hash").withColumn("diagonal", F.col("pos") - F.col("item_pos"))
    # which words of the item are covered, and which slot values meet: both bounded by the item
    meet = F.expr("transform(sequence(0, cast(size(slots) / 2 as int) - 1), i -> struct(slots[2 * i] as place, item_slots[2 * i + 1] as theirs, slots[2 * i + 1] as ours))")
    meet = F.when(F.size("slots") > 0, F.transform(meet, lambda s: F.struct((s.place % 64).alias("kind"), s.theirs.alias("theirs"), s.ours.alias("ours")))).otherwise(F.expr("array()"))
    few = F.size("item_slots") <= F.col("size")  # two entries a slot: at least half the words are literal
    occ = pairs.withColumn("meet", meet).groupBy("doc_id", "row", "item_id", "diagonal", "item_words").agg(
        F.collect_set(F.when(few, F.struct("item_pos", "size"))).alias("spots"), F.collect_set(F.when(few, F.col("meet"))).alias("meet"), F.min("pos").alias("at"),
        F.collect_set(F.struct("item_pos", "size")).alias("all_spots"), F.collect_set("meet").alias("all_meet"),
    )
    covered = lambda c: F.expr(f"size(array_distinct(flatten(transform({c}, s -> sequence(s.item_pos, s.item_pos + s.size - 1)))))").cast("long")
    occ = occ.withColumns({"covered": covered("spots"), "whole": covered("all_spots"), "meet": F.array_distinct(F.flatten("meet")), "all_meet": F.array_distinct(F.flatten("all_meet"))})
    fits = F.expr("size(array_distinct(transform(meet, m -> struct(m.kind, m.theirs)))) = size(meet) and size(array_distinct(transform(meet, m -> struct(m.kind, m.ours)))) = size(meet)")
    least = F.least(F.lit(need), F.greatest(F.lit(1), F.col("item_words") - 1))
    own = F.expr("forall(all_meet, m -> m.theirs = m.ours)") & (F.col("whole") >= least)
    occ = occ.withColumn("own", own).where(F.col("own") | (F.col("covered") >= least) & fits)
    verbatim = F.col("own") | F.expr("forall(meet, m -> m.theirs = m.ours)")
    return occ.select("doc_id", "row", "item_id", "at", F.when(F.col("own"), F.col("whole")).otherwise(F.col("covered")).alias("covered"), "item_words", verbatim.alias("verbatim"))


def contaminated(docs: DataFrame, benchmark: DataFrame, need: int = NEED, slot_heavy: bool = False) -> DataFrame:
    """doc_id, item_id, occurrences, covered, item_words, verbatim: one row for each document and item it repeats.

    ``verbatim``: some occurrence has the item's own slot values; else it was re-parameterised.  Null or empty texts
    match nothing, nor do items without words.  Repeated rows of a doc_id count as one document; rows with a null
    doc_id are one document too.  Empty tables give no rows.
    """
    occ = occurrences(docs, benchmark, need, slot_heavy)
    return occ.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("occurrences"), F.max("covered").alias("covered"), F.max("item_words").alias("item_words"), F.max("verbatim").alias("verbatim"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, need: int = NEED, slot_heavy: bool = True) -> DataFrame:
    """The rows of ``docs``, all their columns (of any names), whose text repeats no benchmark item.

    Rows that share a doc_id with one that repeats an item go with it, those without an id likewise; null and empty
    texts stay.  An empty benchmark keeps all rows, an empty table gives an empty result.
    """
    return by_keys(docs, occurrences(docs, benchmark, need, slot_heavy).select("doc_id"), "doc_id", "left_anti", checkpoint)
