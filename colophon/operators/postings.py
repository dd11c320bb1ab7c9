"""Boolean queries by a positional index: many queries over many texts in one pass.

Texts are taken apart into postings: runs of ASCII letters and digits, their places, and what lies
between them. A term of the Boolean language (``plans.boolean``) is such runs with what lies
between them; it is looked up by its rarest run, and a phrase's other runs by place, in those texts alone. Terms that several
queries share are looked up once. Postings are never kept or shuffled whole: those of the runs looked up go on.

A query is filed under the terms of which a text must hold at least one, chosen so that the fewest texts hold one;
``NOT`` requires nothing. The texts that hold one are its candidates, and for those alone the other terms are
looked at and the query is judged, as a program over the numbers of the terms that hold. A query that a text without any of its
terms meets is judged by what its negation finds (an anti join); there may be
``MOST_NEGATIVE`` of these, as each returns nearly all texts.

Equal to ``boolean.predicate`` on every text and query. Defined results: null and empty texts hold no terms; queries
without a tree match nothing; repeated rows count once, and of two texts of one id one must hold a term, not
both; of two queries of one id one is taken; a term without a letter or digit raises ``ValueError``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.plans import boolean
from colophon.storage import fixed

MOST_NEGATIVE = 64
#: Rows of a table of terms or ids that are broadcast; larger ones are shuffled.
MOST_BROADCAST = 50_000
RUN = r"[A-Za-z0-9]+"
SPACE = r"[ \t\n\x0b\f\r]+"

COMPILED = (
    "query_id {id}, negated boolean, program array<struct<op: string, arg: int>>,"
    " leaves array<struct<leaf: int, term: string, lead: string, runs: array<string>, gaps: array<string>, trail: string>>"
)


def term_parts(text: str) -> tuple[str, list[str], list[str], str]:
    """What stands before a term's first run, its runs, what lies between them, and what follows."""
    spaced = " ".join(text.split())
    runs = re.findall(RUN, spaced)
    if not runs:
        raise ValueError(f"a term without letters or digits: {text!r}")
    lead, *gaps, trail = re.split(RUN, spaced)
    return lead, [r.lower() for r in runs], gaps, trail


def pushed(tree, negated: bool = False):
    """The tree with NOT at terms alone."""
    if isinstance(tree, boolean.Not):
        return pushed(tree.of, not negated)
    if isinstance(tree, boolean.Term):
        return boolean.Not(tree) if negated else tree
    kind = boolean.All if isinstance(tree, boolean.All) != negated else boolean.Some
    return kind(tuple(pushed(p, negated) for p in tree.parts))


def required(tree, cost: dict[str, int]) -> set[str] | None:
    """Terms of which every text that meets the tree holds one, of the least cost; None if there are none."""
    if isinstance(tree, boolean.Term):
        return {tree.text}
    if isinstance(tree, boolean.Not):
        return None
    parts = [required(p, cost) for p in tree.parts]
    if isinstance(tree, boolean.Some):
        return None if None in parts else set().union(*parts)
    return min((p for p in parts if p is not None), key=lambda p: (sum(cost.get(t, 0) for t in p), sorted(p)), default=None)


def program(tree, numbers: dict[str, int]) -> list[tuple[str, int]]:
    """The tree in postfix: ``t`` with a term's number, ``n``, ``a`` and ``o`` with how many values they take."""
    if isinstance(tree, boolean.Term):
        return [("t", numbers[tree.text])]
    if isinstance(tree, boolean.Not):
        return [*program(tree.of, numbers), ("n", 1)]
    made = [step for p in tree.parts for step in program(p, numbers)]
    return [*made, ("a" if isinstance(tree, boolean.All) else "o", len(tree.parts))]


def terms_of(tree) -> list[str]:
    if isinstance(tree, boolean.Term):
        return [tree.text]
    parts = (tree.of,) if isinstance(tree, boolean.Not) else tree.parts
    return list(dict.fromkeys(t for p in parts for t in terms_of(p)))


def tree_of(query: str | None):
    """The query's tree, negated if texts without any of its terms meet it, and whether it is."""
    try:
        tree = pushed(boolean.parse(query or ""))
    except ValueError:
        return None, False
    return (tree, False) if required(tree, {}) else (pushed(tree, True), True)


def compiled(queries: DataFrame) -> DataFrame:
    """The queries (query_id, query) as programs over their terms; those without a tree are left out."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for frame in batches:
            rows = []
            for key, text in zip(frame["query_id"], frame["query"]):
                tree, negated = tree_of(text)
                if tree is None:
                    continue
                terms = terms_of(tree)
                leaves = []
                for k, term in enumerate(terms):
                    lead, runs, gaps, trail = term_parts(term)
                    leaves.append({"leaf": k, "term": term, "lead": lead, "runs": runs, "gaps": gaps, "trail": trail})
                steps = [{"op": op, "arg": arg} for op, arg in program(tree, {t: k for k, t in enumerate(terms)})]
                rows.append((key, negated, steps, leaves))
            yield pd.DataFrame(rows, columns=["query_id", "negated", "program", "leaves"])

    kinds = COMPILED.format(id=queries.schema["query_id"].dataType.simpleString())
    return queries.select("query_id", "query").dropDuplicates(["query_id"]).mapInPandas(run, kinds)


def taken_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``words`` of their texts, in lower case, and the ``between`` around them; white space is one blank."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ")
    words = F.transform(F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(1)), F.lower)
    return docs.withColumns({"words": words, "between": F.split(text, RUN, -1)}).drop("text").filter(F.size("words") > 0)


def postings(docs: DataFrame) -> DataFrame:
    """``(doc_id, place, run, before, after, previous, next, last)`` of texts (doc_id, text)."""
    n, none = F.size("words"), F.array(F.lit(None).cast("string"))
    zipped = F.arrays_zip(
        F.col("words").alias("run"),
        F.slice("between", 1, n).alias("before"),
        F.slice("between", F.lit(2), n).alias("after"),
        F.concat(none, F.slice("words", F.lit(1), n - 1)).alias("previous"),
        F.concat(F.slice("words", F.lit(2), n - 1), none).alias("next"),
    )
    rows = taken_apart(docs.select("doc_id", "text")).select("doc_id", n.alias("n"), F.posexplode(zipped).alias("place", "x"))
    return rows.select("doc_id", "place", "x.*", (F.col("place") == F.col("n") - 1).alias("last"))


def every_run(docs: DataFrame) -> DataFrame:
    """``(run)``: the runs of all texts, in lower case; repeats stay, places and what lies between are not made."""
    runs = docs.select(F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    return runs.select(F.lower("run").alias("run"))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has few rows; else joins shuffle."""
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def edges(before: Column, after: Column, first: Column, last: Column) -> tuple[Column, Column]:
    """Whether a term may begin after ``before`` (``first``: with the text) and may end before ``after``."""
    lead, trail = F.col("lead"), F.col("trail")
    opens = (lead == "") | (before.endswith(lead) & ((F.length(before) > F.length(lead)) | first))
    return opens, (trail == "") | (after.startswith(trail) & ((F.length(after) > F.length(trail)) | last))


def hits(terms: DataFrame, docs: DataFrame) -> DataFrame:
    """``(no, doc_id)``: which texts hold which terms (no, lead, runs, gaps, trail).

    A first pass counts the terms' runs in all texts, a second one looks up each term's rarest run, where what is
    before and after it, the next runs included, must fit already. What is left of longer phrases is held against the
    texts, place by place.
    """
    size, k = F.size("runs"), F.col("k")
    runs = terms.select("no", F.posexplode("runs").alias("k", "run"))
    asked = bounded(runs.select("run").distinct())
    counts = every_run(docs).join(asked, "run", "left_semi").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    rarest = runs.join(counts, "run").groupBy("no").agg(F.min(F.struct("n", "k")).alias("x"), F.count(F.lit(1)).alias("known"))
    rarest = rarest.select("no", "known", F.col("x.k").alias("k")).join(terms, "no").filter(F.col("known") == size)  # others are in no text
    rarest = fixed(rarest.select("no", "k", "lead", "runs", "gaps", "trail", F.get("runs", k).alias("run")))
    opens, ends = edges(F.col("before"), F.col("after"), F.col("place") == 0, F.col("last"))
    before = F.when(k == 0, opens).otherwise((F.col("before") == F.get("gaps", k - 1)) & (F.col("previous") == F.get("runs", k - 1)))
    after = F.when(k == size - 1, ends).otherwise((F.col("after") == F.get("gaps", k)) & (F.col("next") == F.get("runs", k + 1)))
    bare = (F.col("lead") == "") & (F.col("trail") == "")
    seen = (size == 1) | bare & (k <= 1) & (size - k <= 2)  # nothing of the term lies further off
    found = postings(docs).join(bounded(rarest), "run").filter(F.coalesce(before & after, F.lit(False)) & (F.col("place") >= k))
    # where more is to be seen the place stays, else the text is enough
    found = fixed(found.select("no", "doc_id", F.when(~seen, F.col("place") - k).alias("start")).distinct())
    open_ = found.filter("start is not null")
    if open_.isEmpty():
        return found.select("no", "doc_id")
    asked = fixed(open_.groupBy("doc_id").agg(F.collect_list(F.struct("no", "start")).alias("asked")))
    texts = docs.select("doc_id", "text").join(bounded(asked.select("doc_id")), "doc_id", "left_semi").join(asked, "doc_id")
    placed = taken_apart(texts).select("doc_id", "words", "between", F.explode("asked").alias("x")).select("doc_id", "words", "between", "x.*")
    placed = placed.join(bounded(rarest.select("no", "lead", "runs", "gaps", "trail")), "no")
    start, n = F.col("start"), size
    same = F.slice("words", start + 1, n) == F.col("runs")
    gaps = F.slice("between", start + 2, n - 1) == F.col("gaps")
    opens, ends = edges(F.get("between", start), F.get("between", start + n), start == 0, start + n == F.size("words"))
    whole = placed.filter(same & gaps & opens & ends).select("no", "doc_id")
    return found.filter("start is null").select("no", "doc_id").unionByName(whole).distinct()


def judged(steps: Column, have: Column) -> Column:
    """The value of a program where ``have`` are the numbers of the terms that hold."""

    def step(stack: Column, x: Column) -> Column:
        n = F.size(stack)
        last = F.slice(stack, n - x["arg"] + 1, x["arg"])
        rest = F.slice(stack, F.lit(1), n - x["arg"])
        value = F.when(x["op"] == "n", ~F.element_at(stack, -1)).when(x["op"] == "a", F.forall(last, lambda v: v)).otherwise(F.exists(last, lambda v: v))
        return F.when(x["op"] == "t", F.concat(stack, F.array(F.array_contains(have, x["arg"])))).otherwise(F.concat(rest, F.array(value)))

    return F.element_at(F.aggregate(steps, F.array().cast("array<boolean>"), step), 1)


def filed(programs: DataFrame, queries: DataFrame, costs: DataFrame) -> DataFrame:
    """``(query_id, term)``: the terms each query is filed under, from how many texts hold each (term, n)."""
    terms = programs.select("query_id", F.explode("leaves").alias("x")).select("query_id", F.col("x.term").alias("term"))
    known = terms.join(costs, "term", "left").groupBy("query_id").agg(F.collect_list(F.struct("term", F.coalesce("n", F.lit(0)).alias("n"))).alias("costs"))

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for frame in batches:
            rows = []
            for key, text, costs_ in zip(frame["query_id"], frame["query"], frame["costs"]):
                tree, _ = tree_of(text)
                rows += [(key, t) for t in sorted(required(tree, {c["term"]: c["n"] for c in costs_}))]
            yield pd.DataFrame(rows, columns=["query_id", "term"])

    asked = queries.select("query_id", "query").dropDuplicates(["query_id"]).join(known, "query_id")
    return asked.mapInPandas(run, f"query_id {queries.schema['query_id'].dataType.simpleString()}, term string")


def search(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """``(query_id, doc_id)`` of texts (doc_id, text) that meet the queries (query_id, query)."""
    queries = fixed(queries.filter("query_id is not null").dropDuplicates(["query_id"]))
    programs = fixed(compiled(queries))
    leaves = programs.select("query_id", F.explode("leaves").alias("x")).select("query_id", "x.*")
    terms = leaves.select("term", "lead", "runs", "gaps", "trail").distinct()
    terms = fixed(fixed(terms).withColumn("no", F.monotonically_increasing_id()))
    names = terms.select("term", "no")
    found = fixed(hits(terms, docs))
    costs = found.groupBy("no").agg(F.count(F.lit(1)).alias("n")).join(names, "no").select("term", "n")
    under = filed(programs, queries, costs).join(names, "term")
    candidates = under.join(found, "no").select("query_id", "doc_id").distinct()
    held = candidates.join(leaves.join(names, "term").select("query_id", "leaf", "no"), "query_id").join(found, ["no", "doc_id"])
    held = held.groupBy("query_id", "doc_id").agg(F.collect_set("leaf").alias("have"))
    met = held.join(programs.select("query_id", "negated", "program"), "query_id").filter(judged(F.col("program"), F.col("have")))
    negative = [r["query_id"] for r in programs.filter("negated").select("query_id").limit(MOST_NEGATIVE + 1).collect()]
    if not negative:
        return met.select("query_id", "doc_id")
    if len(negative) > MOST_NEGATIVE:
        raise ValueError(f"over {MOST_NEGATIVE} queries that require no term")
    met = fixed(met.select("query_id", "doc_id", "negated"))
    ids = F.array(*map(F.lit, negative)).cast(f"array<{queries.schema['query_id'].dataType.simpleString()}>")
    every = docs.select("doc_id").distinct().select(F.explode(ids).alias("query_id"), "doc_id")
    rest = every.join(met.filter("negated").select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")
    return met.filter("not negated").select("query_id", "doc_id").unionByName(rest)
