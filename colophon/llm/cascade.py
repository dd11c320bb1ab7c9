"""Quality rules as a short-circuit cascade.

Every rule is a Spark column that is true where a document breaks it. A rule's cost and the share
of documents it rejects are estimated on a sample, and the cascade tries the rules in order of
rejection per cost: the first that rejects names the verdict, and what follows it is not computed
for that document (``CASE`` branches are lazy in Spark). The order decides speed alone: a document
is kept if and only if no rule rejects it. All of it is DataFrame expressions.

The sample is drawn by a hash and summed up where it lies, so no text reaches the driver. Its cost
is counted in characters, words and lines times a fixed cost of each measure, not in seconds, so
the same table gives the same order each time.

Defined results: a null text counts as empty; an empty text has no words and fails ``min_words``;
rows are treated one by one, so repeated rows and ties change nothing; very long texts are measured
whole; columns of the input are kept, but measures and ``rejected_by`` replace input columns of the
same name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm.common import let

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def word_list(text: Column) -> Column:
    """Words: runs of anything but ASCII white space; a split at one character needs no regular expression."""
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def word_chars(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def symbol_count(text: Column, symbols: str = SYMBOLS) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{symbols}]+", "")).cast("long")


def line_list(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def duplicate_lines(lines: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_window_words(words: Column, window: int = 3) -> Column:
    """Words inside a window of ``window`` words that the text holds twice or more.

    Windows are sorted by a 64-bit hash next to their position; neighbours with one hash are
    compared word by word. Positions of repeated windows then cover up to ``window`` words each.
    """

    def same(w: Column, i: Column, j: Column) -> Column:
        out = F.lit(True)
        for k in range(window):
            out = out & (F.get(w, i + k) == F.get(w, j + k))
        return out

    def pairs(w: Column, s: Column) -> Column:
        n = F.size(s) - 1
        twins = F.zip_with(
            F.slice(s, F.lit(1), n),
            F.slice(s, F.lit(2), n),
            lambda a, b: F.when((a["h"] == b["h"]) & same(w, a["i"], b["i"]), F.array(a["i"], b["i"])),
        )
        return F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))

    def covered(p: Column) -> Column:
        n = F.size(p)
        steps = F.zip_with(
            F.slice(p, F.lit(1), n - 1), F.slice(p, F.lit(2), n - 1), lambda a, b: F.least(F.lit(window), b - a)
        )
        return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(steps, F.lit(window), lambda acc, x: acc + x))

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        single = F.transform(w, lambda x: F.xxhash64(x))
        hashes = let(single, lambda h: F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])))

        def sort(h: Column) -> Column:
            placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                let(F.sort_array(placed), lambda s: let(pairs(w, s), covered))
            )

        return F.when(F.size(w) <= window, F.lit(0)).otherwise(let(hashes, sort))

    return let(words, of).cast("long")


Measures = dict[str, Column]

#: Measures of a text ``t``, its words ``w`` and its lines ``l``.
MEASURES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "n_words": lambda t, w, l: F.size(w).cast("long"),
    "word_chars": lambda t, w, l: word_chars(w),
    "n_symbols": lambda t, w, l: symbol_count(t),
    "n_lines": lambda t, w, l: F.size(l).cast("long"),
    "n_dup_lines": lambda t, w, l: duplicate_lines(l),
    "n_repeat_words": lambda t, w, l: repeated_window_words(w),
}
LINE_MEASURES = ("n_lines", "n_dup_lines")
#: Cost of each measure for a character, a word and a line, in nanoseconds of one core, by timing each alone.
COSTS = {
    "n_words": (0, 1, 0),
    "word_chars": (0, 50, 0),
    "n_symbols": (10, 0, 0),
    "n_lines": (4, 0, 1000),
    "n_dup_lines": (4, 0, 4000),
    "n_repeat_words": (0, 640, 0),
}
UNKNOWN_COST = (10, 100, 100)


@dataclass(frozen=True)
class Rule:
    """``rejects`` makes a column, true for a document that goes, from the measures in ``needs``."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Measures], Column]


def base_rules(min_words: int = 50, max_repeat_percent: int = 50) -> list[Rule]:
    return [
        Rule("min_words", ("n_words",), lambda m: m["n_words"] < min_words),
        Rule(
            "repeats",
            ("n_words", "n_repeat_words"),
            lambda m: 100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"],
        ),
    ]


def default_rules(
    max_symbol_percent: int = 10,
    max_dup_line_percent: int = 50,
    min_word_length: float = 2.0,
    max_word_length: float = 25.0,
) -> list[Rule]:
    """Base rules and three more: symbols against word characters, repeated lines, mean word length."""

    def word_length(m: Measures) -> Column:
        mean = m["word_chars"] / F.greatest(m["n_words"], F.lit(1))
        return (m["n_words"] > 0) & ((mean < min_word_length) | (mean > max_word_length))

    return [
        *base_rules(),
        Rule(
            "symbols",
            ("word_chars", "n_symbols"),
            lambda m: 100 * m["n_symbols"] > max_symbol_percent * m["word_chars"],
        ),
        Rule(
            "dup_lines",
            ("n_lines", "n_dup_lines"),
            lambda m: 100 * m["n_dup_lines"] > max_dup_line_percent * m["n_lines"],
        ),
        Rule("word_length", ("n_words", "word_chars"), word_length),
    ]


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every measure as a column."""
    parts = docs.withColumn("_text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    parts = parts.withColumns({"_words": word_list(F.col("_text")), "_lines": line_list(F.col("_text"))})
    found = {k: f(F.col("_text"), F.col("_words"), F.col("_lines")) for k, f in MEASURES.items()}
    return parts.withColumns(found).drop("_text", "_words", "_lines")


def measure(name: str, t: Column, w: Column) -> Column:
    """A measure of the text ``t`` with words ``w``."""
    of = MEASURES[name]
    return let(line_list(t), lambda l: of(t, w, l)) if name in LINE_MEASURES else of(t, w, w)


def _cascade(rules: list[Rule], t: Column, w: Column, leaf: Callable[[str | None, Measures], Column]) -> Column:
    """``leaf`` of the first rule that rejects (or none) and of the measures computed until then."""

    def step(rest: list[Rule], have: Measures) -> Column:
        if not rest:
            return leaf(None, have)
        missing = [k for k in rest[0].needs if k not in have]
        if missing:
            return let(measure(missing[0], t, w), lambda x: step(rest, have | {missing[0]: x}))
        return F.when(rest[0].rejects(have), leaf(rest[0].name, have)).otherwise(step(rest[1:], have))

    return step(rules, {})


def verdict(text: Column, rules: list[Rule]) -> Column:
    """Name of the first of ``rules`` that rejects, or null; later measures wait for earlier rules."""

    def named(name: str | None, have: Measures) -> Column:
        return F.lit(name).cast("string")

    return let(F.coalesce(text, F.lit("")), lambda t: let(word_list(t), lambda w: _cascade(rules, t, w, named)))


def verdict_with_measures(text: Column, rules: list[Rule]) -> Column:
    """A struct of ``rejected_by`` and all measures; those that the cascade skipped are computed after it."""

    def found(name: str | None, have: Measures) -> Column:
        none = F.lit(None).cast("long")
        return F.struct(F.lit(name).cast("string").alias("rejected_by"), *[have.get(k, none).alias(k) for k in MEASURES])

    def filled(t: Column, w: Column) -> Column:
        def rest(s: Column) -> Column:
            return F.struct(s["rejected_by"].alias("rejected_by"), *[F.coalesce(s[k], measure(k, t, w)).alias(k) for k in MEASURES])

        return let(_cascade(rules, t, w, found), rest)

    return let(F.coalesce(text, F.lit("")), lambda t: let(word_list(t), lambda w: filled(t, w)))


def rule_order(docs: DataFrame, rules: list[Rule], text: str = "text", sample_rows: int = 512) -> list[Rule]:
    """``rules`` by rejection per cost, both estimated on about ``sample_rows`` documents.

    Each next rule is judged on what the ones before it leave, and doesn't pay again for measures
    that they computed. Ties go by name. The sample only sets the order, never a verdict.
    """
    plain = [F.col(f"`{f.name}`") for f in docs.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.filter(F.pmod(F.xxhash64(*plain), F.lit(1 << 30)) < int(share * (1 << 30))).select(F.col(f"`{text}`").alias("_sample"))
    measured = with_measures(sample, "_sample")
    have = {k: F.col(k) for k in MEASURES}
    broken = F.array(*[F.coalesce(r.rejects(have), F.lit(False)) for r in rules]).alias("broken")
    size = F.char_length(F.coalesce("_sample", F.lit("")))
    sums = [F.count(F.lit(1)), *(F.sum(x) for x in (size, F.col("n_words"), F.col("n_lines")))]
    groups = [(r[0], r[1:]) for r in measured.groupBy(broken).agg(*sums).collect()] if rules else []
    ordered: list[Rule] = []
    done: set[str] = set()
    left = list(range(len(rules)))
    while left:
        totals = [sum(g[1][k] for g in groups) for k in range(4)]

        def key(i: int) -> tuple[float, str]:
            units = [COSTS.get(m, UNKNOWN_COST) for m in rules[i].needs if m not in done]
            cost = totals[0] + sum(c * n for u in units for c, n in zip(u, totals[1:])) + 1
            rejected = sum(g[1][0] for g in groups if g[0][i])
            return -(rejected + 1) / cost, rules[i].name

        best = min(left, key=key)
        left.remove(best)
        ordered.append(rules[best])
        done |= {*rules[best].needs}
        groups = [g for g in groups if not g[0][best]]
    return ordered


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = 512, measures: bool = False) -> DataFrame:
    """``docs`` with ``rejected_by``: the first rule of the ordered cascade that rejects, or null.

    ``measures`` adds all measures, also those that a document's cascade had no need of.
    """
    ordered = rule_order(docs, default_rules() if rules is None else rules, text, sample_rows)
    if not measures:
        return docs.withColumn("rejected_by", verdict(F.col(f"`{text}`"), ordered))
    names = ("rejected_by", *MEASURES)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    found = docs.select(*kept, verdict_with_measures(F.col(f"`{text}`"), ordered).alias("_judged"))
    return found.select(*kept, "_judged.*")


def quality_filter(
    docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = 512
) -> DataFrame:
    """Documents that no rule rejects, with the columns of ``docs``."""
    ordered = rule_order(docs, default_rules() if rules is None else rules, text, sample_rows)
    return docs.filter(verdict(F.col(f"`{text}`"), ordered).isNull())
