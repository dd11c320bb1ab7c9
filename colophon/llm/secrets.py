"""Secret scan: three fixed patterns, and entropy in sliding windows, all as Spark expressions.

Matches are bracketed in the text by two control characters (those in the text itself are first
replaced by a third), and the lengths of the parts between give the places as code points.

The entropy method looks at candidate strings of 20 or more token characters. Parts of a candidate,
between separators, that hold a word of the allow list are blanked. For each character class (hex
digits; base64) a window slides over what is left; the counts of its characters and the sum of
``c * log2(c)`` change by the character that enters and the one that leaves, which gives the
Shannon entropy. A candidate counts if a window within the class reaches the class's threshold,
unless it is of an allowed form as a whole: a UUID, a run of the hex digits in order, a path of
words, or digits alone.

Repeated groups of the patterns are possessive, so the regex engine works in a loop and long strings
don't fill its stack. Work is linear in the text, but for the places of ``n`` matches, which take
``n * log(n)``.

Defined results: a null or empty text has no spans; texts are scanned one by one, so repeated rows
and ties change nothing; very long texts and candidates are scanned whole; columns of the input are
kept, and ``secrets`` replaces one of that name; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm.common import let

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a shorter run holds no longer one
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]

#: Characters of each class and the entropy, in bits, that a window of it has to reach.
CLASSES = {
    "hex": ("0123456789abcdefABCDEF", 3.0),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", 3.9),
}
WINDOW = 20
#: Rounding of sums of logarithms; the entropies of windows of 20 lie further apart.
ROUNDING = 1e-9
#: Candidates that are no secrets as a whole: UUIDs, the hex digits in order, paths of words, numbers.
ALLOWED = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"(?i)(?:0123456789abcdef)++",
    r"[-_/=+]*+(?:[A-Za-z]++[-_/=+]*+)++(?:[0-9]{1,4}+[-_/=+]*+)?",
    r"[-_/=+0-9]++",
)
#: A part of a candidate that holds one of these words is a placeholder.
ALLOWED_PART = r"(?i)example|placeholder|changeme|dummy|sample"

_SPAN = "array<struct<start: int, rank: int, kind: string, end: int, value: string>>"


def running_sums(numbers: Column) -> Column:
    """Sums of an array up to each of its elements, by doubling the span of what is summed."""

    def doubled(sums: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k).cast("int")
        return F.transform(sums, lambda x, i: x + F.when(i >= back, F.get(sums, i - back)).otherwise(0))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers).cast("double"))).cast("int"))
    return F.aggregate(rounds, numbers, doubled)


def matches(text: Column, pattern: str, kind: str) -> Column:
    """Spans of leftmost, non-overlapping matches, with their text."""
    clean = F.replace(F.replace(text, F.lit("\x01"), F.lit("\x03")), F.lit("\x02"), F.lit("\x03"))
    parts = F.split(F.regexp_replace(clean, f"(?:{pattern})", "\x01$0\x02"), "[\x01\x02]")

    def spans(p: Column) -> Column:
        def at(ends: Column) -> Column:
            def span(i: Column) -> Column:
                return F.struct(
                    F.get(ends, i - 1).alias("start"),
                    F.lit(KINDS.index(kind)).alias("rank"),
                    F.lit(kind).alias("kind"),
                    F.get(ends, i).alias("end"),
                    F.get(p, i).alias("value"),
                )

            return F.transform(F.sequence(F.lit(1), F.size(p) - 2, F.lit(2)), span)

        ends = running_sums(F.transform(p, lambda x: F.char_length(x)))
        return F.when(F.size(p) > 1, let(ends, at)).otherwise(F.array()).cast(_SPAN)

    return let(parts, spans)


def window_entropy(candidate: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Highest Shannon entropy of a window of ``alphabet`` characters; -1 where there is none.

    The counts of the window's characters are a string with a letter for each character, so that a
    change copies a few bytes.
    """
    zero = ord("A")
    zeros = F.lit(chr(zero) * len(alphabet))

    def term(count: Column) -> Column:
        return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))

    def of(places: Column) -> Column:
        def changed(counts: Column, total: Column, at: Column, by: int) -> Column:
            def to(old: Column) -> Column:
                new = F.overlay(counts, F.char(old + zero + by), at, F.lit(1))
                return F.struct(new.alias("counts"), (total + term(old + by) - term(old)).alias("total"))

            return let(F.ascii(F.substring(counts, at, F.lit(1))) - zero, to)

        def state(counts: Column, total: Column, run: Column, best: Column) -> Column:
            return F.struct(counts.alias("counts"), total.alias("total"), run.alias("run"), best.alias("best"))

        def rated(c: Column, run: Column, best: Column) -> Column:
            entropy = F.lit(log2(window)) - c["total"] / window
            return state(c["counts"], c["total"], run, F.when(run >= window, F.greatest(best, entropy)).otherwise(best))

        def step(s: Column, i: Column) -> Column:
            def entered(e: Column) -> Column:
                left = changed(e["counts"], e["total"], F.get(places, i - window), -1)
                return let(F.when(s["run"] >= window, left).otherwise(e), lambda c: rated(c, s["run"] + 1, s["best"]))

            outside = state(zeros, F.lit(0.0), F.lit(0), s["best"])
            inside = let(changed(s["counts"], s["total"], F.get(places, i), 1), entered)
            return F.when(F.get(places, i) == 0, outside).otherwise(inside)

        start = state(zeros, F.lit(0.0), F.lit(0), F.lit(-1.0))
        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), start, step, lambda s: s["best"])

    chars = F.transform(F.split(candidate, ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(alphabet), c)))
    return let(chars, of)


def looks_secret(candidate: Column) -> Column:
    allowed = reduce(lambda a, b: a | b, [candidate.rlike(f"^(?:{p})$") for p in ALLOWED])
    parts = F.split(candidate, "(?<=[-_/=+])")
    rest = F.array_join(F.transform(parts, lambda x: F.when(x.rlike(ALLOWED_PART), " ").otherwise(x)), "")
    high = [window_entropy(rest, letters) >= bits - ROUNDING for letters, bits in CLASSES.values()]
    return F.when(allowed, F.lit(False)).otherwise(reduce(lambda a, b: a | b, high))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: spans (start, end, kind, value) by start, then kind."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    assigned = F.filter(matches(t, ASSIGN, "assign"), lambda s: F.char_length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    entropy = F.filter(matches(t, CANDIDATE, "entropy"), lambda s: looks_secret(s["value"]))
    found = F.concat(assigned, matches(t, ACCESS, "access"), matches(t, HEX, "hex"), entropy)
    return docs.withColumn("secrets", F.array_sort(found))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    named = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(named, ",")
