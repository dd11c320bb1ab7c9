"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Small trees are grown on labelled rows by gradient boosting; every path from a root is a rule, a
conjunction of thresholds on statistics. A logistic regression with an L1 penalty weighs the rules
and leaves few. The rest becomes one Spark column expression, so scoring runs in the JVM over all
rows. Statistics are DataFrame expressions on the whole text; nothing else is an input.

Fitting uses at most ``max_rows`` labelled ids, taken in order of a hash of the id, and one row of
statistics for each, so the driver's memory is bounded whatever the corpus holds.

Defined results: a null or empty text is scored by its statistics (all zero); labels that are null
or neither 0 nor 1, ids with both labels and ids without a document are not learned from; of an id
with several texts the one of least statistics is; without both classes the score is the share of
label 1 (0.5 without labels); repeated rows are scored alike, very long texts whole; columns of the
input are kept, and ``score`` replaces one of that name; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm import cascade


def _count(pattern: str) -> Column:
    """Characters of the text that ``pattern``, a character class, matches."""
    return F.char_length(F.regexp_replace("_scored", f"[^{pattern}]+", ""))


def statistics() -> dict[str, Column]:
    """Statistics by name, over the text and the measures of the rule cascade."""
    chars, words = F.greatest(F.col("word_chars"), F.lit(1)), F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "words": F.log1p(F.col("n_words").cast("double")),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / chars,
        "upper": _count(r"\p{Lu}") / chars,
        "digits": _count("0-9") / chars,
        "marks": _count("!?") / words,
        "stops": _count(".,;:") / words,
        "line_words": F.col("n_words") / lines,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
    }


NAMES = ("words", "word_length", "symbols", "upper", "digits", "marks", "stops", "line_words", "dup_lines", "repeats")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_all``, a struct of the columns of ``docs``, and ``_stats``, a struct of the statistics."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all")
    packed = docs.select(whole, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_scored"))
    found = statistics()
    stats = F.struct(*[found[k].cast("double").alias(k) for k in NAMES])
    return cascade.with_measures(packed, "_scored").select("_all", stats.alias("_stats"))


Condition = tuple[int, bool, float]  # statistic, whether it is over the threshold, threshold
Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleEnsemble:
    """Bias and weighted rules; the score is the logistic function of their sum."""

    bias: float
    rules: tuple[tuple[float, Rule], ...]

    def column(self, stats: str = "_stats") -> Column:
        total = F.lit(self.bias)
        for weight, rule in self.rules:
            met = None
            for k, over, threshold in rule:
                x = F.col(f"{stats}.{NAMES[k]}")
                part = x > threshold if over else x <= threshold
                met = part if met is None else met & part
            total = total + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _tree(x: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, least: int):
    """Paths of a tree that fits ``gradient / hessian``, and the values of its leaves by row."""
    paths: list[Rule] = []
    value = np.zeros(len(gradient))

    def grow(rows: np.ndarray, path: Rule) -> None:
        if path:
            paths.append(path)
        g, h = gradient[rows], hessian[rows]
        best = (1e-6, None, None)
        if len(path) < depth and len(rows) >= 2 * least:
            base = g.sum() ** 2 / (h.sum() + 1)
            for k in range(x.shape[1]):
                edges = cuts[k]
                bins = np.searchsorted(edges, x[rows, k], side="left")
                left_g = np.cumsum(np.bincount(bins, g, len(edges) + 1))[:-1]
                left_h = np.cumsum(np.bincount(bins, h, len(edges) + 1))[:-1]
                n = np.cumsum(np.bincount(bins, minlength=len(edges) + 1))[:-1]
                gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - base
                gain[(n < least) | (len(rows) - n < least)] = -1
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), k, float(edges[gain.argmax()]))
        if best[1] is None:
            value[rows] = g.sum() / (h.sum() + 1)
            return
        over = x[rows, best[1]] > best[2]
        grow(rows[~over], (*path, (best[1], False, best[2])))
        grow(rows[over], (*path, (best[1], True, best[2])))

    grow(np.arange(len(gradient)), ())
    return paths, value


def meets(x: np.ndarray, rule: Rule) -> np.ndarray:
    met = np.ones(len(x), bool)
    for k, over, threshold in rule:
        met &= (x[:, k] > threshold) if over else (x[:, k] <= threshold)
    return met


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, m = a.shape
    rate = 4.0 * n / (np.square(a).sum() + n)  # under the inverse of the loss's curvature
    w, bias = np.zeros(m), 0.0
    v, vb, t = w.copy(), bias, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-np.clip(a @ v + vb, -30, 30))) - y
        new = v - rate * (a.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_bias = vb - rate * error.mean()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_next * (new - w), new_bias + (t - 1) / t_next * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
    return bias, w


def fit_rules(
    x: np.ndarray, y: np.ndarray, trees: int = 12, depth: int = 3, penalty: float = 5e-4, steps: int = 400
) -> RuleEnsemble:
    """Rules and weights from statistics ``x`` and labels ``y``."""
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 20 or share in (0.0, 1.0):
        share = min(max(share, 1e-3), 1 - 1e-3)
        return RuleEnsemble(float(np.log(share / (1 - share))), ())
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 49))) for k in range(x.shape[1])]
    margin, found = np.full(len(y), np.log(share / (1 - share))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        paths, value = _tree(x, cuts, y - p, p * (1 - p), depth, max(5, len(y) // 500))
        margin += 0.5 * value
        found |= dict.fromkeys(paths)
    rules = list(found)
    a = np.stack([meets(x, r) for r in rules], axis=1).astype(np.float64) if rules else np.zeros((len(y), 0))
    bias, w = _lasso(a, y, penalty, steps)
    kept = [(float(c), r) for c, r in zip(w, rules) if abs(c) > 1e-3]
    return RuleEnsemble(float(bias), tuple(kept))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text: str = "text",
    max_rows: int = 20_000,
) -> RuleEnsemble:
    """An ensemble from the labelled documents, at most ``max_rows`` of them."""
    known = labels.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{label}`").cast("double").alias("_y"))
    known = known.filter(F.col("_y").isin(0.0, 1.0) & F.col("_id").isNotNull())
    sure = known.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_other")).filter("_y = _other").drop("_other")
    chosen = sure.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    texts = docs.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text}`").alias("_body"))
    found = with_statistics(texts.join(F.broadcast(chosen), "_id"), "_body")
    once = found.groupBy(F.col("_all._id").alias("_id"), F.col("_all._y").alias("_y")).agg(F.min("_stats").alias("_stats"))
    rows = once.select("_y", "_stats.*").toPandas()
    rows = rows.sort_values(["_y", *NAMES])  # the order of tasks doesn't matter
    return fit_rules(rows[list(NAMES)].to_numpy(float), rows["_y"].to_numpy(float))


def score(docs: DataFrame, ensemble: RuleEnsemble, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1."""
    kept = [F.col(f"_all.`{c}`") for c in docs.columns if c != "score"]
    return with_statistics(docs, text).select(*kept, ensemble.column().alias("score"))
