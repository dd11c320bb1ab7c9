"""The Boolean keyword language: lint, parse, compile to a predicate.

``"quoted phrase"``, bare words, ``AND``, ``OR``, ``NOT`` and parentheses; words side by side are
joined by AND; NOT binds tightest, OR loosest. A term matches whole words in any case.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_DATE_TO = "2025-12-31"
TOPIC_FORM = r"^T\d{5}$"


def normalize(query: str) -> str:
    """One line: comment lines off, white space collapsed, none inside parentheses' edges."""
    lines = [line for line in query.splitlines() if not line.strip().startswith("#")]
    text = re.sub(r"\s+", " ", " ".join(lines)).strip()
    return text.replace("( ", "(").replace(" )", ")")


# What the linter takes for operators out of place.
LOWER_OPERATOR = r"\b(and|or|not)\b"
ADJACENT_OPERATORS = r"\b(AND|OR)\s+(AND|OR)\b|\bNOT\s+NOT\b"


def lint(query: str) -> list[str]:
    """What is wrong with a query; empty if nothing."""
    if not query.strip():
        return ["empty query"]
    bare = re.sub(r'"[^"]*"', '""', query)
    checks = [
        (query.count("(") != query.count(")"), "unbalanced parentheses"),
        (query.count('"') % 2 == 1, "odd number of quotes"),
        (re.search(LOWER_OPERATOR, bare), "lower-case operator"),
        (re.search(ADJACENT_OPERATORS, query), "adjacent operators"),
        ("()" in query, "empty parentheses"),
    ]
    return [message for bad, message in checks if bad]


def lint_count(query: Column) -> Column:
    """Number of faults of each row's query, by the rules of ``lint``."""
    bare = F.regexp_replace(query, '"[^"]*"', '""')
    rules = [
        F.regexp_count(query, F.lit(r"\(")) != F.regexp_count(query, F.lit(r"\)")),
        F.regexp_count(query, F.lit('"')) % 2 == 1,
        bare.rlike(LOWER_OPERATOR),
        query.rlike(ADJACENT_OPERATORS),
        query.contains("()"),
    ]
    total = sum((r.cast("int") for r in rules), F.lit(0))
    return F.when(query.rlike(r"^\s*$"), F.lit(1)).otherwise(total)


@dataclass(frozen=True)
class Term:
    text: str


@dataclass(frozen=True)
class Not:
    of: object


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Some:
    parts: tuple


def parse(query: str):
    """Syntax tree of a query; ``ValueError`` where it has none."""
    tokens = re.findall(r'"[^"]*"|[()]|[^\s()"]+', normalize(query))
    at = 0

    def peek() -> str | None:
        return tokens[at] if at < len(tokens) else None

    def some():
        nonlocal at
        parts = [every()]
        while peek() == "OR":
            at += 1
            parts.append(every())
        return parts[0] if len(parts) == 1 else Some(tuple(parts))

    def every():
        nonlocal at
        parts = [unary()]
        while peek() not in (None, "OR", ")"):
            if peek() == "AND":
                at += 1
            parts.append(unary())
        return parts[0] if len(parts) == 1 else All(tuple(parts))

    def unary():
        nonlocal at
        token = peek()
        if token in (None, "AND", "OR", ")"):
            raise ValueError(f"a term is missing before {token or 'the end'}")
        at += 1
        if token == "NOT":
            return Not(unary())
        if token == "(":
            inner = some()
            if peek() != ")":
                raise ValueError("missing )")
            at += 1
            return inner
        return Term(token.strip('"'))

    tree = some()
    if peek() is not None:
        raise ValueError(f"unexpected {peek()}")
    return tree


def predicate(tree, text: Column) -> Column:
    """True where the text, null as empty, meets the tree."""
    text = F.coalesce(text, F.lit(""))
    if isinstance(tree, Term):
        words = r"\s+".join(re.escape(w) for w in tree.text.split())
        return text.rlike(rf"(?i)(?<![A-Za-z0-9]){words}(?![A-Za-z0-9])")
    if isinstance(tree, Not):
        return ~predicate(tree.of, text)
    parts = [predicate(p, text) for p in tree.parts]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if isinstance(tree, All) else out | p
    return out


def filter_text(
    query: str, topics: list[str] = (), date_from: str = "", date_to: str = DEFAULT_DATE_TO, types: list[str] = ()
) -> str:
    """The filter as a service's text: comma is AND, pipe is OR."""
    parts = [f"title_and_abstract.search:{query}"]
    if topics:
        parts.append("primary_topic.id:" + "|".join(topics))
    parts += [f"from_publication_date:{date_from}", f"to_publication_date:{date_to or DEFAULT_DATE_TO}"]
    if types:
        parts.append("type:" + "|".join(types))
    return ",".join(parts)


def filter_works(
    works: DataFrame,
    query: str,
    topics: list[str] = (),
    date_from: str | None = None,
    date_to: str | None = DEFAULT_DATE_TO,
    types: list[str] = (),
    text: tuple[str, ...] = ("title", "abstract_text"),
) -> DataFrame:
    """The same filter over a table: the conditions on columns reach the scan."""
    out = works
    if topics:
        out = out.filter(F.col("primary_topic_id").isin(*topics))
    if date_from:
        out = out.filter(F.col("publication_date") >= date_from)
    if date_to:
        out = out.filter(F.col("publication_date") <= date_to)
    if types:
        out = out.filter(F.col("type").isin(*types))
    return out.filter(predicate(parse(query), F.concat_ws(" ", *text)))


#: Buckets of terms that each widen a query, and buckets that only count with one another.
ALONE, TOGETHER = ("1_core_technology", "2_methods_tools"), ("3_mechanisms", "4_applications")


def any_of(terms: list[str]) -> str:
    """The terms joined by OR, phrases and hyphenated words in quotes; empty without terms."""
    words = [f'"{w}"' if {" ", "-"} & set(w) else w for w in map(str.strip, terms) if w]
    return f"({' OR '.join(words)})" if words else ""


def bounded_query(buckets: dict[str, list[str]]) -> str:
    """``((core OR methods) OR (mechanisms AND applications))``; one alone of the last two is left out."""
    wide, narrow = ([any_of(buckets.get(name) or []) for name in names] for names in (ALONE, TOGETHER))
    groups = [" OR ".join(filter(None, wide)), " AND ".join(narrow) if all(narrow) else ""]
    if not any(groups):
        raise ValueError("no terms to search for")
    return f"({' OR '.join(f'({g})' for g in groups if g)})"


#: Characters with a meaning in a service's filters, and how they are written in a DOI.
ESCAPED_COMMA = "%252C"
TITLE_WORDS = 10


def doi_predicate(dois: list[str]) -> str:
    """A service's filter for any of the DOIs; commas, which mean AND there, are escaped twice."""
    return "doi:" + "|".join(d.replace(",", ESCAPED_COMMA) for d in dois)


def title_predicate(title: str, exact: bool = False) -> str:
    """A service's filter for a title: its first ten words, or the title as a phrase."""
    return f'display_name.search:"{title}"' if exact else "title.search:" + " ".join(title.split()[:TITLE_WORDS])


def topic_id_ok(x: Column) -> Column:
    return F.coalesce(x.rlike(TOPIC_FORM), F.lit(False))


def topics_exist(ids: DataFrame, topics: DataFrame) -> DataFrame:
    """``(topic_id, exists)``."""
    known = topics.select(F.col("topic_id").alias("known")).distinct()
    return ids.join(known, F.col("topic_id") == F.col("known"), "left").select("topic_id", F.col("known").isNotNull().alias("exists"))
