"""A quality classifier as a sparse ensemble of rules over statistics of texts.

Small trees are boosted on the labelled rows; every path from a root to a node below it is a rule, a conjunction of comparisons. A logistic model
with an L1 penalty over all rules, fitted by accelerated proximal gradient steps, keeps a few of them, each with a weight.
Those are compiled into Spark column expressions, so scoring is one projection over the statistics.

The penalty is the largest whose loss on a fifth of the training rows, left out for that, is within a percent of the best. Training uses at
most ``sample_rows`` labelled documents (those with the lowest hash of doc_id); scores use nothing but the text.

A null text counts as empty and is scored like any other text without words. Rows without a doc_id or label don't take part in training. With one label
only, the score is that label's share. Repeated rows are scored alike; a repeated doc_id counts by its lowest label. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.samples import one_each, sample
from quotelake.llm.textstats import RATIOS, STATISTICS, batch_statistics, ratios

SAMPLE_ROWS = 8000
TREES = 24
DEPTH = 3
LEAST_LEAF = 10
CUTS = 48
PENALTIES = (0.02, 0.01, 0.005, 0.0025, 0.001)

FEATURES = (*RATIOS, "log_words", "distinct_words")

Condition = tuple[int, bool, float]  # feature, above (else: at most), threshold
Rule = tuple[Condition, ...]


class Ensemble(NamedTuple):
    rules: list[Rule]
    weights: np.ndarray
    bias: float


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    n = np.maximum(s["n_words"], 1)
    return np.column_stack((ratios(s), np.log1p(s["n_words"]), s["n_distinct"] / n))


def _with_features(keep: tuple[str, ...]):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = features(batch_statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in keep), *(pa.array(rows[:, k]) for k in range(len(FEATURES)))], names=[*keep, *FEATURES]
            )

    return found


_SCHEMA = ", ".join(f"{name} double" for name in FEATURES)


def tree_rules(rows: np.ndarray, good: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = 0.3, seed: int = 3) -> list[Rule]:
    """The paths of boosted regression trees on the gradient of the logistic loss, each grown on half of the rows."""
    random = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, CUTS + 2)[1:-1])) for k in range(rows.shape[1])]
    cells = np.column_stack([np.searchsorted(c, rows[:, k], "left") for k, c in enumerate(cuts)])
    total, rules = np.zeros(len(rows)), {}
    for _ in range(trees):
        gap = good - 1 / (1 + np.exp(-total))
        half = random.random(len(rows)) < 0.5
        waiting: list[tuple[np.ndarray, Rule]] = [(np.ones(len(rows), bool), ())]
        while waiting:
            own, path = waiting.pop()
            if path:
                rules[path] = True
            split = _best_split(cells[own & half], gap[own & half], cuts) if len(path) < depth else None
            if split is None:
                chance = 1 / (1 + np.exp(-total[own]))
                total[own] += rate * gap[own].sum() / max((chance * (1 - chance)).sum(), 1e-3) if own.any() else 0
                continue
            feature, at = split
            above = cells[:, feature] > at
            threshold = float(cuts[feature][at])
            for side in (False, True):
                waiting.append((own & (above == side), (*path, (feature, side, threshold))))
        total = np.clip(total, -8, 8)
    return list(rules)


def _best_split(cells: np.ndarray, gap: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, int] | None:
    best, found = 1e-9, None
    for k, own in enumerate(cuts):
        n = np.bincount(cells[:, k], minlength=len(own) + 1).cumsum()[:-1]
        low = np.bincount(cells[:, k], gap, len(own) + 1).cumsum()[:-1]
        rest, high = len(gap) - n, gap.sum() - low
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where((n >= LEAST_LEAF) & (rest >= LEAST_LEAF), low**2 / n + high**2 / rest - gap.sum() ** 2 / max(len(gap), 1), 0)
        if len(gain) and gain.max() > best:
            best, found = float(gain.max()), (k, int(gain.argmax()))
    return found


def holds(rules: list[Rule], rows: np.ndarray) -> np.ndarray:
    out = np.ones((len(rows), len(rules)), bool)
    for k, rule in enumerate(rules):
        for feature, above, threshold in rule:
            out[:, k] &= (rows[:, feature] > threshold) == above
    return out


def lasso(held: np.ndarray, good: np.ndarray, penalty: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias with the least mean logistic loss plus penalty * sum of absolute weights."""
    x = np.column_stack((held.astype(float), np.ones(len(held))))
    power = np.ones(x.shape[1])
    for _ in range(20):
        power = x.T @ (x @ power)
        power /= np.linalg.norm(power)
    step = 4 * len(x) / max(np.linalg.norm(x @ power) ** 2, 1e-9)
    w = ahead = np.zeros(x.shape[1])
    pace = 1.0
    for _ in range(steps):
        new = ahead - step * (x.T @ (1 / (1 + np.exp(-np.clip(x @ ahead, -40, 40))) - good)) / len(x)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead, w, pace = new + (pace - 1) / faster * (new - w), new, faster
    return w[:-1], float(w[-1])


def _loss(held: np.ndarray, good: np.ndarray, w: np.ndarray, bias: float) -> float:
    z = held @ w + bias
    return float(np.mean(np.logaddexp(0, z) - good * z))


def fitted(rows: np.ndarray, good: np.ndarray) -> Ensemble:
    if not len(good) or good.all() or not good.any():
        share = (good.sum() + 1) / (len(good) + 2)
        return Ensemble([], np.zeros(0), float(np.log(share / (1 - share))))
    rules = tree_rules(rows, good)
    held = holds(rules, rows)
    # a rule that holds for the same rows as an earlier one says nothing new
    _, first = np.unique(held, axis=1, return_index=True)
    rules, held = [rules[k] for k in sorted(first)], held[:, sorted(first)]
    checked = np.arange(len(rows)) % 5 == 0
    losses = [_loss(held[checked], good[checked], *lasso(held[~checked], good[~checked], p)) for p in PENALTIES]
    penalty = next(p for p, loss in zip(PENALTIES, losses, strict=True) if loss <= 1.01 * min(losses) + 1e-4)
    w, bias = lasso(held, good, penalty)
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return Ensemble([rules[k] for k in kept], w[kept], bias)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Ensemble:
    """labels: doc_id, quality; only the rows to learn from."""
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    chosen = sample(marked, "doc_id", sample_rows, 23)
    # sample_rows is a parameter, so the broadcast has a bound
    texts = one_each(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "doc_id", "text", "quality")
    found = texts.select("doc_id", "quality", "text").mapInArrow(_with_features(("doc_id", "quality")), f"doc_id long, quality int, {_SCHEMA}")
    rows = found.toPandas().sort_values(["doc_id", *FEATURES], kind="stable")
    return fitted(rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), rows["quality"].to_numpy() == 1)


def compiled(ensemble: Ensemble) -> Column:
    """The score as a column expression over FEATURES."""

    def condition(c: Condition) -> Column:
        return F.col(FEATURES[c[0]]) > F.lit(c[2]) if c[1] else F.col(FEATURES[c[0]]) <= F.lit(c[2])

    total = F.lit(ensemble.bias)
    for rule, weight in zip(ensemble.rules, ensemble.weights.tolist(), strict=True):
        total = total + F.when(reduce(and_, map(condition, rule)), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def scored(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """doc_id, the features, score: one row per document."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_with_features(("doc_id",)), f"doc_id long, {_SCHEMA}")
    return rows.withColumn("score", compiled(ensemble))
