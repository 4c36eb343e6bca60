"""Scalar text functions as Columns; all run in the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word borders that Java and other engines agree on (letters of any script count as word characters).
_EDGE_L, _EDGE_R = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
# The word lists, thresholds and patterns that results depend on.
LEXICON = {
    "nsfw": "nude|porn|xxx|explicit|nsfw|sexual|fetish",
    "toxicity": "idiot|stupid|hate|kill|slur",
    "illicit": "how to make a bomb|credit card dump|exploit kit|c2 server",
    "pii": r"\d{3}-\d{2}-\d{4}",
}
THRESHOLDS = {"nsfw": 0.55, "toxicity": 0.50, "illicit": 0.35, "pii": 0.60}
CORRECTION = r"(?iu)^(no($|[^\p{L}\p{N}_])|nah($|[^\p{L}\p{N}_])|not exactly|that['’]s not|incorrect|wrong|what\?|huh|doesn['’]t\s+answer|you didn['’]t|clarify|correction)"
ACKNOWLEDGE = rf"(?iu){_EDGE_L}(thanks|ok|great|got it){_EDGE_R}"
APOLOGY = rf"(?iu){_EDGE_L}(sorry|my bad|apologize){_EDGE_R}"


def strip(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def nfc(c: Column) -> Column:
    """NFC, by the ICU library that Spark ships with; null stays null."""
    return F.when(c.isNotNull(), F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(c, F.lit("")), F.lit(False)))


def norm_text(c: Column) -> Column:
    """NFC, three or more line feeds to two, stripped."""
    return strip(F.regexp_replace(nfc(c), "\n{3,}", "\n\n"))


def normalize_recipe(c: Column) -> Column:
    """Recipe v1: NFKC, runs of Unicode white space to one space, stripped; case stays; null stays null."""
    wide = F.when(c.isNotNull(), F.call_function("java_method", F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(c, F.lit("")), F.lit(True)))
    return F.trim(F.regexp_replace(wide, r"(?U)\s+", " "))


def html_to_text(c: Column) -> Column:
    """Scripts, styles and tags each to one space; character references stay."""
    for pattern in (r"(?is)<script.*?>.*?</script>", r"(?is)<style.*?>.*?</style>", r"<[^>]+>"):
        c = F.regexp_replace(c, pattern, " ")
    return c


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")


def token_count(c: Column) -> Column:
    """White-space tokens, at least 1."""
    return F.greatest(F.lit(1), F.size(tokens(c))).cast("long")


def safety_scores(c: Column) -> dict[str, Column]:
    """1.0 or 0.0 for each lexicon.

    Few texts hold any of the phrases, so a search for their bytes in the lower-cased text comes first and the pattern,
    tens of times slower, runs on what it finds.  Letters that only case folding makes ASCII go to the pattern, too.
    """
    low = F.lower(c)
    odd = [F.contains(c, F.lit(x)) for x in "\u017f\u0131\u0130\u212a"]
    out = {}
    for k, p in LEXICON.items():
        words = ["-"] if "\\" in p else p.split("|")
        maybe = reduce(or_, [F.contains(low, F.lit(w)) for w in words] + odd)
        out[k] = F.when(maybe, F.coalesce(c.rlike(rf"(?iu){_EDGE_L}({p}){_EDGE_R}"), F.lit(False))).otherwise(F.lit(False)).cast("double")
    return out


def risk_tags(scores: dict[str, Column], thresholds: dict[str, float] = THRESHOLDS, order: tuple[str, ...] = ("nsfw", "toxicity", "illicit", "pii")) -> Column:
    """Names whose score reaches its threshold, in order; a missing score counts as 0, a missing threshold as 1."""
    return F.array_compact(F.array(*[F.when(F.coalesce(scores.get(k, F.lit(0.0)), F.lit(0.0)) >= thresholds.get(k, 1.0), F.lit(k)) for k in order]))


def zone(tags: Column) -> Column:
    return F.when(F.size(tags) > 0, "red_quarantine").otherwise("silver_normalized")


def urls(c: Column) -> Column:
    """Sorted distinct http(s) URLs."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?i)https?://[^\s\")]+"), F.lit(0))))


def preview(c: Column, longest: int = 120) -> Column:
    return F.when(F.length(c) > longest, F.concat(F.left(c, F.lit(longest - 3)), F.lit("…"))).otherwise(c)


def safe_name(c: Column) -> Column:
    return F.left(F.regexp_replace(c, r"[^\w\-]+", "_"), F.lit(80))


def _utc(us: Column) -> Column:
    """Microseconds since the epoch to the ISO date and time in UTC without a fraction, whatever the session's time zone."""
    at = F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("string")
    return F.replace(F.substring_index(at, ".", 1), F.lit(" "), F.lit("T"))


def epoch_iso(c: Column) -> Column:
    """Seconds since the epoch to ISO 8601 in UTC, microseconds only where there are any; null stays null."""
    us = F.round(c * 1_000_000).cast("long")
    part = F.pmod(us, F.lit(1_000_000))
    return F.concat(_utc(us), F.when(part != 0, F.concat(F.lit("."), F.lpad(part.cast("string"), 6, "0"))).otherwise(""), F.lit("+00:00"))


def epoch_ms_iso(c: Column) -> Column:
    """Seconds since the epoch to ISO 8601 with milliseconds and Z; null is a dash."""
    ms = F.floor(c * 1000).cast("long")
    return F.coalesce(F.concat(_utc(ms * 1000), F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"), F.lit("Z")), F.lit("—"))


def squeezed(c: Column, longest: int = 120) -> Column:
    """White space runs to one space; longer texts are cut and end in an ellipsis."""
    one = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    return F.when(F.length(one) > longest, F.concat(F.left(one, F.lit(longest - 1)), F.lit("…"))).otherwise(one)


MODE_LIMITS = {"ess_hi": 0.65, "ci_hi": 0.70, "tc_dom": 0.60, "ci_lo": 0.40, "tc_amb": 0.40, "ess_mid": 0.45, "di_broad": 2.0, "ci_mid": 0.55, "sp_hi": 0.65, "ess_lo": 0.30}


def answer_mode(ess: Column, ci: Column, di: Column, tc: Column, sp: Column, ir: Column, limits: dict[str, float] | None = None) -> Column:
    """Ordered rules; the first that holds names the mode, none of them: H."""
    t = MODE_LIMITS | (limits or {})
    rules = [
        (ir, "G"),
        ((ess >= t["ess_hi"]) & (ci >= t["ci_hi"]) & (di >= 2) & (tc >= t["tc_dom"]), "A"),
        ((ess >= t["ess_hi"]) & (ci < t["ci_lo"]) & (di >= 2), "B"),
        (tc < t["tc_amb"], "D"),
        ((ess >= t["ess_mid"]) & (di > t["di_broad"]) & (ci >= t["ci_mid"]), "E"),
        ((sp >= t["sp_hi"]) & (ess >= t["ess_mid"]), "F"),
        (ess < t["ess_lo"], "C"),
    ]
    return F.coalesce(*[F.when(rule, F.lit(mode)) for rule, mode in rules], F.lit("H"))


def rerank_score(cross: Column, dense: Column, bm25: Column, authority: Column, length: Column, recency_days: Column) -> Column:
    """Logistic of a weighted sum; missing features are 0, a missing or zero recency is 365 days."""
    z = lambda c: F.coalesce(c, F.lit(0.0))
    raw = 1.2 * z(cross) + 0.6 * z(dense) + 0.3 * z(bm25) + 0.2 * z(authority) - 0.1 * z(length) - 0.2 * F.coalesce(F.when(recency_days != 0, recency_days), F.lit(365.0)) / 30.0
    return 1.0 / (1.0 + F.exp(-raw))
