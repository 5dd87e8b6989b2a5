"""Quality classifier: a sparse ensemble of rules over document statistics, scored as Spark columns."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglark.llm.statistics import FEATURES, held_out, measured, training_rows
from loglark.llm.trees import Tree, boost, sigmoid

#: Labelled documents learned from, at most, for each label.
PER_CLASS = 8000
THRESHOLD = 0.3
TREES, DEPTH, SAMPLE = 24, 3, 0.6
PENALTY, STEPS = 0.002, 400

#: A condition is (feature, 1 if at least the threshold or 0 if below, threshold); a rule is a conjunction.
Rule = tuple[tuple[int, int, float], ...]


def paths(tree: Tree) -> list[Rule]:
    """The rule of every node below the root. Of conditions on one feature and side the tightest stays."""
    out = []

    def down(node: int, rule: dict[tuple[int, int], float]) -> None:
        if rule:
            out.append(tuple((f, side, t) for (f, side), t in sorted(rule.items())))
        f, t = int(tree.feature[node]), float(tree.threshold[node])
        if f < 0:
            return
        down(int(tree.left[node]), rule | {(f, 0): min(t, rule.get((f, 0), np.inf))})
        down(int(tree.right[node]), rule | {(f, 1): max(t, rule.get((f, 1), -np.inf))})

    down(0, {})
    return out


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, [(x[:, f] >= t) if side else (x[:, f] < t) for f, side, t in rule])


def lasso(z: np.ndarray, y: np.ndarray, penalty: float, steps: int) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic regression with an L1 penalty, by accelerated proximal steps."""
    n, k = z.shape
    weight, ahead = np.zeros(k + 1), np.zeros(k + 1)
    padded = np.hstack([np.ones((n, 1)), z])
    size = 4 * n / max(float(np.linalg.norm(padded, 2) ** 2), 1e-9)
    t = 1.0
    for _ in range(steps):
        step = ahead - size * (padded.T @ (sigmoid(padded @ ahead) - y) / n)
        new = np.sign(step) * np.maximum(np.abs(step) - size * penalty, 0)
        new[0] = step[0]
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - weight)
        weight = new
    return float(weight[0]), weight[1:]


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[float, Rule]]]:
    """Intercept and the rules that keep a weight. Rules that mark the same rows count once."""
    _, trees = boost(x, y, TREES, DEPTH, sample=SAMPLE, seed=1)
    rules: dict[bytes, Rule] = {}
    for tree in trees:
        for rule in paths(tree):
            mark = holds(rule, x)
            if 0 < mark.sum() < len(y):
                rules.setdefault(np.packbits(mark).tobytes(), rule)
    kept = list(rules.values())
    rate = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
    if not kept:
        return float(np.log(rate / (1 - rate))), []
    z = np.stack([holds(r, x) for r in kept], axis=1).astype(np.float64)
    bias, weights = lasso(z, y, PENALTY, STEPS)
    return bias, [(float(w), r) for w, r in zip(weights, kept, strict=True) if abs(w) > 1e-6]


def compiled(bias: float, rules: list[tuple[float, Rule]]) -> Column:
    """The score as one column expression over the statistics."""
    total = F.lit(bias)
    for weight, rule in rules:
        conditions = [
            (F.col(FEATURES[f]) >= F.lit(t)) if side else (F.col(FEATURES[f]) < F.lit(t)) for f, side, t in rule
        ]
        total = total + F.when(reduce(Column.__and__, conditions), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = PER_CLASS,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, n_rules.

    Trees are grown on the statistics of at most ``per_class`` labelled documents of each
    label; every path is a rule, and a lasso keeps a sparse weighted set of them. Documents
    with crc32(id as text) mod 5 = 0 are never learned from. A null text is scored as an
    empty one, all statistics zero; a null id is not held out; repeated rows are scored
    alike; without labels every score is 0.5. An empty table gives an empty result; a text of
    any length is read whole. Of an id that has several labels or texts, any one is learned from.
    Only the id and the text of ``docs`` are read.
    """
    bias, rules = fit(*training_rows(docs, labels, label, per_class, id_col, text_col))
    return measured(docs, id_col, text_col).select(
        F.col("row_id").alias("doc_id"),
        F.coalesce(held_out("row_id", 5, 0), F.lit(False)).alias("held_out"),
        compiled(bias, rules).alias("score"),
        F.lit(len(rules)).alias("n_rules"),
    ).select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_rules")
