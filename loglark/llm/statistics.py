"""Statistics of whole documents, computed in batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import smallest_hashes, with_package
from loglark.llm.shingles import _SPACE, K, _mix, _PLACE, word_hashes

SYMBOLS = b"#*$%&|<>"

#: Exact counts, then ratios that models read. ``text_`` keeps them apart from table columns.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "words",
    "mean_word",
    "symbols",
    "upper",
    "digits",
    "bangs",
    "marks",
    "dup_lines",
    "repeats",
    "distinct",
    "top_word",
    "line_words",
    "wide",
)
SCHEMA = "row_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"s_{r} double" for r in RATIOS)
FEATURES = tuple(f"s_{r}" for r in RATIOS)


def _set(chars: bytes) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(chars)] = True
    return flags


_SYMBOL = _set(SYMBOLS)
_UPPER, _LOWER, _DIGIT = _set(bytes(range(65, 91))), _set(bytes(range(97, 123))), _set(b"0123456789")
_MARK = _set(bytes(c for c in range(33, 127) if not chr(c).isalnum()))


def repeated_words(hashes: np.ndarray, k: int = K) -> int:
    """Words that lie in a window of ``k`` words found at least twice."""
    n = len(hashes) - k + 1
    if n < 2:
        return 0
    windows = sum((hashes[i : i + n] * _PLACE[i] for i in range(1, k)), hashes[:n] * _PLACE[0])
    order = np.argsort(_mix(windows), kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + k, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def measure(text: str | None) -> tuple[list[int], list[float]]:
    """COUNTS and RATIOS of one text; a null text is an empty one, all zero."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, dtype=np.uint8)
    counts = np.bincount(data, minlength=256)
    hashes = word_hashes(text, lower=False)
    n = len(hashes)
    begins = ~_SPACE.copy()
    begins[0x80:0xC0] = False
    chars = int(counts[begins].sum())
    symbols, lines = int(counts[_SYMBOL].sum()), duplicate_lines(raw)
    repeats = repeated_words(hashes)
    words, size = max(n, 1), max(chars, 1)
    distinct, times = np.unique(hashes, return_counts=True)
    upper, lower = int(counts[_UPPER].sum()), int(counts[_LOWER].sum())
    return [n, chars, symbols, lines, repeats], [
        float(np.log1p(n)),
        chars / words,
        symbols / size,
        upper / max(upper + lower, 1),
        int(counts[_DIGIT].sum()) / size,
        int(counts[33]) / size,
        int(counts[_MARK].sum()) / size,
        lines / (int(counts[10]) + 1),
        repeats / words,
        len(distinct) / words,
        int(times.max()) / words if n else 0.0,
        n / (int(counts[10]) + 1),
        int(counts[0xC0:].sum()) / size,
    ]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [measure(t.as_py()) for t in batch.column("text")]
        counts = np.array([c for c, _ in found], dtype=np.int64).reshape(-1, len(COUNTS))
        ratios = np.array([r for _, r in found], dtype=np.float64).reshape(-1, len(RATIOS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), *map(pa.array, counts.T.copy()), *map(pa.array, ratios.T.copy())],
            names=["row_id", *COUNTS, *FEATURES],
        )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row_id`` (the id), COUNTS and FEATURES for each row of ``docs``."""
    slim = with_package(docs).select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_measured, SCHEMA)


def held_out(doc_id, of: int, rest: int):
    """Documents whose labels no model may learn from: crc32(id as text) mod ``of`` = ``rest``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of == rest


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample of labelled documents that are not held out.

    Of each label value the ``per_class`` rows with the smallest hashes of their ids are
    taken. Only these documents are measured, and at most 2 * ``per_class`` rows of numbers come to the driver.
    """
    known = (
        labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out("label_id", 5, 0))
        .dropDuplicates(["label_id"])
    )
    chosen = smallest_hashes(known, "label", "label_id", per_class)
    texts = docs.join(F.broadcast(chosen), docs[id_col] == chosen["label_id"])
    rows = measured(texts, id_col, text_col).join(F.broadcast(chosen), F.col("row_id") == F.col("label_id"))
    table = rows.select("row_id", "label", *FEATURES).dropDuplicates(["row_id"]).orderBy("row_id").toPandas()
    return table[list(FEATURES)].to_numpy(dtype=np.float64), table["label"].to_numpy(dtype=np.float64)
