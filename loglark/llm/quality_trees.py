"""Quality rules: exact base counts, then boosted trees with monotonic constraints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.statistics import COUNTS, FEATURES, measured, training_rows
from loglark.llm.trees import Tree, boost, sigmoid

PER_CLASS = 8000
ROUNDS, DEPTH = 40, 3
THRESHOLD = 0.3

#: The score may only fall as these rise.
FALLING = ("s_symbols", "s_bangs", "s_dup_lines", "s_repeats", "s_digits")

LEAST_WORDS = 10
REPEAT_PERCENT = 20


class Forest:
    """All trees in one set of node arrays; a row walks them side by side."""

    def __init__(self, base: float, trees: list[Tree]) -> None:
        offsets = np.cumsum([0, *[len(t.feature) for t in trees]]).astype(np.int64)
        join = lambda parts, kind: np.concatenate([np.zeros(0), *parts]).astype(kind)
        self.base, self.roots = base, offsets[:-1]
        self.feature = join([t.feature for t in trees], np.int64)
        self.threshold = join([t.threshold for t in trees], np.float64)
        self.left = join([t.left + o for t, o in zip(trees, offsets)], np.int64)
        self.right = join([t.right + o for t, o in zip(trees, offsets)], np.int64)
        self.value = join([t.value for t in trees], np.float64)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), sigmoid(np.array(self.base)))
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        while True:
            feature = self.feature[node]
            if not (feature >= 0).any():
                return sigmoid(self.base + self.value[node].sum(axis=1))
            low = x[rows, np.maximum(feature, 0)] < self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])  # a leaf is its own child


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    signs = {FEATURES.index(f): -1 for f in FALLING}
    return Forest(*boost(x, y, ROUNDS, DEPTH, signs=signs))


def _scored(forest: Forest):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row_id", *COUNTS)), pa.array(forest.score(x), pa.float64())],
                names=["doc_id", *COUNTS, "score"],
            )

    return score


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = PER_CLASS,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, score.

    The counts are exact. ``base_failed`` marks texts with fewer than 10 words or more than
    20 % of their words in repeated five-word windows; they are not kept. Of the others the
    trees keep those that score at least ``threshold``; they learn from at most ``per_class``
    labelled documents of each label, and the score never rises with the FALLING statistics.
    A null text counts as empty and fails; repeated rows and null ids are scored like any
    row; without labels every score is 0.5. An empty table gives an empty result; a text of any
    length is read whole. Of an id that has several labels or texts, any one is learned from.
    Only the id and the text of ``docs`` are read.
    """
    forest = fit(*training_rows(docs, labels, label, per_class, id_col, text_col))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", score double"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        measured(docs, id_col, text_col)
        .mapInArrow(_scored(forest), schema)
        .select(
            "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"), "score"
        )
    )
