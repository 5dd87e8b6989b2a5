"""Language of whole texts by a convolutional network over bytes, trained in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import fresh, smallest_hashes, with_package
from loglark.llm.statistics import held_out

#: Bytes of a window, widths of the filters and filters of each width.
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
DEPTH = 8
#: Labelled documents of each language that are learned from, at most, and windows of each.
PER_LANGUAGE, WINDOWS = 500, 4
EPOCHS, BATCH, RATE = 4, 64, 0.01
UNKNOWN = "und"
#: Documents whose best language scores below this are rejected by ``keep_known``.
LEAST_SCORE = 0.3

_TAIL = max(WIDTHS) - 1
_WIDTH = np.repeat(WIDTHS, FILTERS)


def windows(text: str | bytes) -> np.ndarray:
    """All bytes of the text, A-Z in lower case, in windows of WINDOW.

    The last window is padded, and each is followed by padding for the filters.
    """
    raw = (text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).lower()
    rows = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(rows * WINDOW, dtype=np.uint8)
    out[: len(raw)] = np.frombuffer(raw, dtype=np.uint8)
    return np.pad(out.reshape(rows, WINDOW), ((0, 0), (0, _TAIL)))


class ByteNet:
    """Byte vectors, filters of several widths, the maximum of each over the window, softmax."""

    def __init__(self, classes: list[str], seed: int = 0) -> None:
        rng, n = np.random.default_rng(seed), len(_WIDTH)
        self.classes = classes
        self.byte = rng.normal(0, 0.5, (256, DEPTH)).astype(np.float32)
        #: filter weights by place in the filter; a narrow filter has none at the last places
        used = (np.arange(max(WIDTHS))[:, None] < _WIDTH)[:, None, :]
        self.used = used.astype(np.float32)
        self.filter = (rng.normal(0, 0.3, (max(WIDTHS), DEPTH, n)) * used).astype(np.float32)
        self.shift = np.zeros(n, dtype=np.float32)
        self.dense = rng.normal(0, 0.1, (n, len(classes))).astype(np.float32)
        self.bias = np.zeros(len(classes), dtype=np.float32)

    def tables(self) -> list[np.ndarray]:
        """What a byte at each place of the filters adds, to all filters that are wider."""
        return [np.ascontiguousarray((self.byte @ w)[:, self.wider(k) :]) for k, w in enumerate(self.filter)]

    @staticmethod
    def wider(place: int) -> int:
        """The first filter that has a weight at ``place``."""
        return int((_WIDTH <= place).sum())

    def responses(self, x: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Every filter at every place of each window: (place, window, filter)."""
        x = np.ascontiguousarray(x.T)
        total = np.take(tables[0], x[:WINDOW], axis=0)
        for place in range(1, len(tables)):
            total[:, :, self.wider(place) :] += np.take(tables[place], x[place : place + WINDOW], axis=0)
        return total

    def pooled(self, x: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Maximum of every filter over each window, never below 0."""
        return np.maximum(self.responses(x, tables).max(axis=0) + self.shift, 0)

    def log_softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.dense + self.bias
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 0) -> None:
        """Adam on the cross-entropy. The gradient flows through each filter's best place only."""
        rng = np.random.default_rng(seed)
        names = ("byte", "filter", "shift", "dense", "bias")
        moment = {k: [np.zeros_like(getattr(self, k)) for _ in range(2)] for k in names}
        filters, t = np.arange(len(_WIDTH)), 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for start in range(0, len(order), BATCH):
                rows = order[start : start + BATCH]
                xb, yb = x[rows], y[rows]
                n = len(rows)
                total = self.responses(xb, self.tables())
                best = total.argmax(axis=0)
                h = np.maximum(np.take_along_axis(total, best[None], 0)[0] + self.shift, 0)
                out = np.exp(self.log_softmax(h))
                out[np.arange(n), yb] -= 1
                out /= n
                back = (out @ self.dense.T) * (h > 0)
                grads = {"dense": h.T @ out, "bias": out.sum(0), "shift": back.sum(0)}
                g_filter, g_byte = np.zeros_like(self.filter), np.zeros_like(self.byte)
                for k in range(len(self.filter)):
                    at = xb[np.arange(n)[:, None], best + k]
                    g_filter[k] = np.einsum("nf,nfd->df", back, self.byte[at])
                    np.add.at(g_byte, at.ravel(), (back[:, :, None] * self.filter[k].T[filters]).reshape(-1, DEPTH))
                grads |= {"filter": g_filter * self.used, "byte": g_byte}
                t += 1
                for k, g in grads.items():
                    m, v = moment[k]
                    m *= 0.9
                    m += 0.1 * g
                    v *= 0.999
                    v += 0.001 * g * g
                    step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                    setattr(self, k, (getattr(self, k) - step).astype(np.float32))

    def predict(self, texts: list[str | None]) -> tuple[list[int], list[float]]:
        """Best class of each text and its probability, from the mean over all its windows."""
        parts = [windows(t or "") for t in texts]
        counts = np.array([len(p) for p in parts])
        x, tables = np.concatenate(parts), self.tables()
        scores = np.concatenate(
            [self.log_softmax(self.pooled(x[i : i + BATCH], tables)) for i in range(0, len(x), BATCH)]
        )
        mean = np.add.reduceat(scores, np.cumsum(counts) - counts) / counts[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return p.argmax(axis=1).tolist(), p.max(axis=1).astype(float).tolist()


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = PER_LANGUAGE) -> ByteNet | None:
    """A network for the languages of ``docs``, or None without a labelled text.

    It learns from documents with crc32(id as text) mod 4 other than 2: of each language the
    ``per_language`` ones with the smallest hashes, WINDOWS pieces of each, spread over its
    text. That bounded sample comes to the driver.
    """
    text = F.col(text_col)
    piece = F.expr(
        f"explode(transform(sequence(0, {WINDOWS - 1}), i -> substring(text, cast(floor(length(text) * i / {WINDOWS}) as int) + 1, {WINDOW})))"
    )
    labelled = docs.where(text.rlike(r"\p{L}") & F.col(lang_col).isNotNull() & ~held_out(id_col, 4, 2))
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
    chosen = smallest_hashes(labelled, "lang", "id", per_language).distinct()
    rows = (
        docs.select(F.col(id_col).alias("id"), text.alias("text"), F.col(lang_col).cast("string").alias("lang"))
        .join(F.broadcast(chosen), ["id", "lang"])
        .select("id", "lang", piece.alias("piece"))
        .orderBy("lang", "id", "piece")
        .collect()
    )
    if not rows:
        return None
    classes = sorted({r.lang for r in rows})
    x = np.concatenate([windows(r.piece.encode("utf-8", "surrogatepass")[:WINDOW]) for r in rows])
    net = ByteNet(classes)
    net.train(x, np.array([classes.index(r.lang) for r in rows]))
    return net


def _predicted(net: ByteNet):
    def predict(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            best, score = net.predict(texts.tolist()) if len(texts) else ([], [])
            yield pd.DataFrame({"lang": [net.classes[b] for b in best], "score": score})

    return predict


def _with_language(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, name: str) -> DataFrame:
    """``docs`` with a struct column ``name`` of the best language and its score; null without a model."""
    net = train(docs, id_col, text_col, lang_col, per_language)
    kind = "lang string, score double"
    if net is None:
        return docs.withColumn(name, F.lit(None).cast(f"struct<{kind.replace(' ', ':').replace(',:', ',')}>"))
    return with_package(docs).withColumn(name, F.pandas_udf(_predicted(net), kind)(F.col(text_col)))


def _known(text_col: str):
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Every byte of a text is in one window of 128 bytes; each window gives log-probabilities,
    and their mean over the text decides. A text without a letter or a null text is ``und``
    with score 1, as is every text where no document has a language. A null id is not held
    out and not learned from; repeated rows are predicted alike; an empty table gives an
    empty result. Only the id, the text and, to learn, the language are read.
    """
    name = fresh(docs, "_language")[0]
    known = _known(text_col) & F.col(name).isNotNull()
    return _with_language(docs, id_col, text_col, lang_col, per_language, name).select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(held_out(id_col, 4, 2), F.lit(False)).alias("held_out"),
        F.when(known, F.col(f"{name}.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.col(f"{name}.score")).otherwise(1.0).alias("score"),
    )


def keep_known(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", least: float = LEAST_SCORE
) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of at least ``least``."""
    name = fresh(docs, "_language")[0]
    found = _with_language(docs, id_col, text_col, lang_col, PER_LANGUAGE, name)
    return found.where(_known(text_col) & (F.col(f"{name}.score") >= least)).drop(name)
