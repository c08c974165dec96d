"""Quality by a sparse ensemble of rules.

Small boosted trees over statistics of labelled texts are grown, every path from
a root to a node is a conjunctive rule, and a logistic model with a lasso
penalty gives a weight to few of them. The ensemble is compiled into one Spark
column expression, so that scores need no Python and no shuffle.
"""

from __future__ import annotations

import math
import operator
import random
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Labelled rows that are learned from, at most; the bound keeps the broadcast and the driver's matrix small.
SAMPLE = 20_000
#: Trees, their depth, and the share of a step that each one goes.
TREES, DEPTH, STEP = 40, 3, 0.3
#: Thresholds that are tried for a statistic, and rows that a rule must hold for (fewer where the rarer label has under four times as many).
CUTS, LEAST_ROWS = 32, 10

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_SYMBOLS, _STOPS, _BANGS, _SPACES = "#*$%&|<>@^~=+_\\/{}[]", ".,;:", "!?", " \t\n\x0b\x0c\r"

# --- statistics ------------------------------------------------------------------

#: What rules are about: SQL over the measures of ``_measures``.
STATISTICS = {
    "n_words": "n_words",
    "word_length": "(n_chars - n_space) / greatest(n_words, 1)",
    "longest_word": "longest",
    "upper_share": "n_upper / greatest(n_upper + n_lower, 1)",
    "letter_share": "(n_upper + n_lower) / greatest(n_chars - n_space, 1)",
    "digit_share": "n_digits / greatest(n_chars - n_space, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "bang_share": "n_bangs / greatest(n_words, 1)",
    "stop_share": "n_stops / greatest(n_words, 1)",
    # On a scale of logarithms, as long texts repeat more of their words.
    "richness": "ln(n_distinct + 1) / ln(greatest(n_words, 1) + 1)",
    "words_in_line": "n_words / greatest(n_lines, 1)",
    "repeated_lines": "(n_lines - n_distinct_lines) / greatest(n_lines, 1)",
}


def statistics(docs: DataFrame, *others: str) -> DataFrame:
    """``others`` and a ``stats`` array, in the order of ``STATISTICS``, of every row of ``docs``; a null text is empty.

    Built-in functions over whole texts. A share of nothing is 0.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("text", r"\n"), lambda x: F.trim(x) != "")
    texts = docs.select(*others, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    split = texts.select(*others, "text", words.alias("words"), lines.alias("lines"), F.length("text").alias("n_chars"))
    # What is left of a text without some characters tells how many it has.
    without = {"n_upper": _UPPER, "n_lower": _LOWER, "n_digits": _DIGITS, "n_symbols": _SYMBOLS, "n_bangs": _BANGS, "n_stops": _STOPS, "n_space": _SPACES}
    measured = split.select(
        *others, "n_chars", *((F.col("n_chars") - F.length(F.translate("text", chars, ""))).alias(n) for n, chars in without.items()),
        F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"), F.coalesce(F.array_max(F.transform("words", F.length)), F.lit(0)).alias("longest"),
        F.size("lines").alias("n_lines"), F.size(F.array_distinct("lines")).alias("n_distinct_lines"),
    )
    return measured.select(*others, F.array(*(F.expr(sql).cast("double") for sql in STATISTICS.values())).alias("stats"))


# --- rules -----------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """All of ``bounds``: for each statistic (by number) the least and the first too large value; ``-inf`` and ``inf`` are open."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        return reduce(operator.and_, ((x[:, k] >= a) & (x[:, k] < b) for k, a, b in self.bounds))

    def column(self, stats: Column) -> Column:
        tests = [stats[k] >= F.lit(a) for k, a, _ in self.bounds if a > -math.inf] + [stats[k] < F.lit(b) for k, _, b in self.bounds if b < math.inf]
        return reduce(operator.and_, tests)

    def __str__(self) -> str:
        names = list(STATISTICS)
        return " AND ".join(f"{a:g} <= {names[k]} < {b:g}" for k, a, b in self.bounds)


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def column(self, stats: Column) -> Column:
        """The probability of label 1."""
        return 1 / (1 + F.exp(-_sum([F.lit(self.bias), *(F.when(r.column(stats), F.lit(w)).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights, strict=True))])))


def _sum(terms: list[Column]) -> Column:
    """Added in pairs, so that the expression stays shallow."""
    while len(terms) > 1:
        terms = [operator.add(*terms[k : k + 2]) if k + 1 < len(terms) else terms[k] for k in range(0, len(terms), 2)]
    return terms[0]


def _with(bounds: dict[int, tuple[float, float]], k: int, low: float, high: float) -> dict[int, tuple[float, float]]:
    a, b = bounds.get(k, (-math.inf, math.inf))
    return bounds | {k: (max(a, low), min(b, high))}


def tree_rules(x: np.ndarray, y: np.ndarray, seed: int = 0, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """The paths of boosted trees, each over a random half of the rows and of the statistics; paths that hold for equal rows count once."""
    chance, n = random.Random(seed), len(y)
    least = max(2, min(LEAST_ROWS, int(min(y.sum(), n - y.sum())) // 4))
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, CUTS + 2)[1:-1])) for k in range(x.shape[1])]
    # The code of a value is the number of cuts that it reaches.
    codes = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cuts)]
    found: dict[bytes, Rule] = {}
    margin = np.full(n, math.log((y.sum() + 1) / (n - y.sum() + 1)))

    def grow(rows: np.ndarray, gradient: np.ndarray, curve: np.ndarray, among: list[int], bounds: dict, left: int) -> list[tuple[np.ndarray, dict]]:
        """Leaves with the rows that they hold."""
        if bounds:
            held = np.zeros(n, bool)
            rule = Rule(tuple((k, *ab) for k, ab in sorted(bounds.items())))
            held = rule.holds(x)
            if least <= held.sum() <= n - least:
                found.setdefault(np.packbits(held).tobytes(), rule)
        best = (1e-6, None, None)
        if left and len(rows) >= 2 * least:
            for k in among:
                g = np.cumsum(np.bincount(codes[k][rows], gradient[rows], len(cuts[k]) + 1))
                h = np.cumsum(np.bincount(codes[k][rows], curve[rows], len(cuts[k]) + 1))
                m = np.cumsum(np.bincount(codes[k][rows], minlength=len(cuts[k]) + 1))
                gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1) - g[-1] ** 2 / (h[-1] + 1)
                gain[(m[:-1] < least) | (m[-1] - m[:-1] < least)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), k, int(gain.argmax()))
        _, k, at = best
        if k is None:
            return [(rows, bounds)]
        low, cut = codes[k][rows] <= at, float(cuts[k][at])
        return grow(rows[low], gradient, curve, among, _with(bounds, k, -math.inf, cut), left - 1) + grow(rows[~low], gradient, curve, among, _with(bounds, k, cut, math.inf), left - 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = y - p, p * (1 - p)
        rows = np.array(sorted(chance.sample(range(n), max(1, n // 2))))
        among = sorted(chance.sample(range(x.shape[1]), (x.shape[1] + 1) // 2))
        for held, bounds in grow(rows, gradient, curve, among, {}, depth):
            if bounds:
                step = gradient[held].sum() / (curve[held].sum() + 1)
                margin[Rule(tuple((k, *ab) for k, ab in sorted(bounds.items()))).holds(x)] += STEP * step
    return list(found.values())


#: Penalties that are tried, in falling order.
PENALTIES = tuple(0.05 * 0.5**k for k in range(7))
#: Parts of the rows that are left out in turn to choose one.
FOLDS = 4


def lasso(z: np.ndarray, y: np.ndarray, penalties: Sequence[float], rounds: int = 300) -> list[np.ndarray]:
    """For each of the falling ``penalties``, the weights and, last, the free bias of a logistic model with an L1 penalty.

    Accelerated proximal gradient steps from the weights before. A column whose
    gradient is too small for the step between two penalties stays out.
    """
    n, out = len(y), []
    w = np.zeros(z.shape[1] + 1)
    w[-1] = math.log((y.sum() + 1) / (n - y.sum() + 1))
    chance, before = lambda x, v: 1 / (1 + np.exp(-np.clip(x @ v[:-1] + v[-1], -30, 30))), penalties[0]
    for penalty in penalties:
        steep = np.abs(z.T @ (chance(z, w) - y)) / n
        active = np.flatnonzero((steep >= 2 * penalty - before) | (w[:-1] != 0))
        x, u = np.ascontiguousarray(z[:, active]), np.append(w[active], w[-1])
        # The curvature is at most a quarter of the largest eigenvalue of the columns' products.
        whole = np.hstack([x, np.ones((n, 1))])
        step = 4 * n / np.linalg.eigvalsh(whole.T @ whole)[-1]
        v, t = u.copy(), 1.0
        for _ in range(rounds):
            p = chance(x, v)
            new = v - step * np.append(x.T @ (p - y), (p - y).sum()) / n
            new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
            now = (1 + math.sqrt(1 + 4 * t * t)) / 2
            v, moved, u, t = new + (t - 1) / now * (new - u), np.abs(new - u).max(), new, now
            if moved < 1e-5:
                break
        w = np.zeros(z.shape[1] + 1)
        w[active], w[-1], before = u[:-1], u[-1], penalty
        out.append(w)
    return out


def fit(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Ensemble:
    """Grow trees, take their paths, weigh them.

    The penalty is the largest one whose cross-validated loss is within a
    standard error of the least. Labels of one
    class alone, or none, give the smoothed share as the score of every text.
    """
    n, positive = len(y), float(y.sum()) if len(y) else 0.0
    prior = math.log((positive + 1) / (n - positive + 1))
    rules = tree_rules(x, y, seed) if 0 < positive < n else []
    if not rules:
        return Ensemble((), (), prior)
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(float)
    fold = np.array([random.Random(f"{seed}:{k}").randrange(FOLDS) for k in range(n)])
    losses = np.full((len(PENALTIES), n), np.nan)
    for f in range(FOLDS):
        kept = fold != f
        if 0 < y[kept].sum() < kept.sum():
            for k, w in enumerate(lasso(z[kept], y[kept], PENALTIES)):
                p = np.clip(1 / (1 + np.exp(-(z[~kept] @ w[:-1] + w[-1]))), 1e-6, 1 - 1e-6)
                losses[k, ~kept] = -(y[~kept] * np.log(p) + (1 - y[~kept]) * np.log(1 - p))
    losses, last = losses[:, ~np.isnan(losses[0])], len(PENALTIES) - 1
    if losses.shape[1]:
        least = losses[losses.mean(axis=1).argmin()]
        last = int(np.argmax(losses.mean(axis=1) <= least.mean() + least.std() / math.sqrt(len(least))))
    w = lasso(z, y, PENALTIES[: last + 1])[-1]
    used = [k for k in np.argsort(-np.abs(w[:-1]), kind="stable") if w[k]]
    return Ensemble(tuple(rules[k] for k in used), tuple(float(w[k]) for k in used), float(w[-1]))


# --- documents -------------------------------------------------------------------


def _held_out(doc_id: Column) -> Column:
    """A null number is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """Learn from at most ``sample`` labelled rows, taken by a hash of their number, none of them held out.

    ``labels`` with a null number or label don't count; of several labels for a
    document the least does, and of several rows of it the greatest statistics.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~_held_out(F.col("doc_id")))
    chosen = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min((F.col("quality") > 0).cast("int")).alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(common.materialize(chosen, "quality-labels")), "doc_id")
    rows = statistics(texts, "doc_id", "quality").groupBy("doc_id").agg(F.max("stats").alias("stats"), F.first("quality").alias("quality")).orderBy("doc_id").collect()
    x = np.array([r.stats for r in rows], float).reshape(len(rows), len(STATISTICS))
    return fit(x, np.array([r.quality for r in rows], float))


def score(docs: DataFrame, model: Ensemble) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_rules`` for every row of ``docs``, in one pass without a shuffle.

    A null text is empty and scores by the rules that hold for no words. Texts
    are read whole, however long. Repeated rows come back as often, a null
    number too; scores of equal texts are equal. Other columns aren't read.
    """
    stats = F.col("stats")
    found = statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    scored = found.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), model.column(stats).alias("score"), _sum([F.lit(0), *(r.column(stats).cast("int") for r in model.rules)]).alias("n_rules"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_rules")
