"""Personal data in whole texts: base patterns, and spans that a trained tagger adds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import stage, with_package
from loglark.llm.pii_rules import KINDS, Span, base_spans, joined, plausible, sha256
from loglark.llm.pii_tagger import WINDOW, Tagger, anchored_windows, padded, reconciled, tags_of, window_spans, window_starts

#: Documents that the tagger learns from and windows of them, at most.
TRAIN_DOCUMENTS, TRAIN_WINDOWS = 4000, 4096
#: Windows decoded at once.
DECODED = 2048

SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def variants(text: str, spans: list[Span]) -> list[tuple[str, list[Span]]]:
    """The text, and forms of its spans that no pattern matches: a phone without its prefix, a spelled-out address."""
    out = [(text, spans)]
    for start, end, kind in spans:
        span = text[start:end]
        if kind == 3:
            new = re.sub(r"^\+[0-9]+[ .-]", "", span)
        elif kind == 0:
            head, _, tail = span.rpartition(".")
            new = f"{head} dot {tail}".replace("@", " at ")
        else:
            continue
        if new != span:
            lead = max(0, start - WINDOW // 2)
            piece = text[lead:start] + new + text[end : end + WINDOW // 2]
            out.append((piece, [(start - lead, start - lead + len(new), kind)]))
    return out


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            text = text or ""
            for piece, spans in variants(text, base_spans(text)):
                starts, codes = anchored_windows(piece, spans)
                tags = tags_of(spans, len(piece))
                rows += [(key, c.tobytes(), tags[s : s + WINDOW].tobytes()) for s, c in zip(starts, codes, strict=True)]
        keys, codes, tags = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(codes, pa.binary()), pa.array(tags, pa.binary())],
            names=["key", "codes", "tags"],
        )


def train(docs: DataFrame, id_col: str, text_col: str) -> Tagger | None:
    """A tagger trained on windows around base spans and their variants, or None if there is no span.

    It learns from the TRAIN_DOCUMENTS documents with a digit or an at sign, as every base
    span has, whose ids hash smallest, and from the TRAIN_WINDOWS of their windows and of
    those of their spans' variants that hash smallest.
    """
    docs = with_package(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    anchored = docs.where(F.col("text").rlike("[0-9@]"))
    chosen = anchored.select("id").orderBy(F.xxhash64("id"), "id").limit(TRAIN_DOCUMENTS).distinct()
    chosen = stage(chosen, "pii-sample")
    rows = anchored.join(F.broadcast(chosen), "id").select(F.xxhash64("id").alias("key"), "text")
    windows = rows.mapInArrow(_labelled, "key long, codes binary, tags binary").distinct()
    sample = windows.orderBy(F.xxhash64("codes"), "codes", "tags").limit(TRAIN_WINDOWS).select("codes", "tags").collect()
    if not sample:
        return None
    codes = np.frombuffer(b"".join(r.codes for r in sample), dtype=np.uint8).reshape(-1, WINDOW)
    tags = np.frombuffer(b"".join(r.tags for r in sample), dtype=np.uint8).reshape(-1, WINDOW)
    if not tags.any():
        return None
    tagger = Tagger()
    tagger.train(codes, tags)
    return tagger


def added_spans(text: str, base: list[Span], found: list[tuple[int, int, int, bool]]) -> list[Span]:
    """Spans of the tagger that are plausible and touch no base span."""
    out = []
    for start, end, kind in reconciled(found, len(text)):
        piece = text[start:end]
        start, end = start + len(piece) - len(piece.lstrip()), end - (len(piece) - len(piece.rstrip()))
        apart = all(end <= s or e <= start for s, e, _ in base)
        apart &= not text[max(start - 1, 0) : start].isalnum() and not text[end : end + 1].isalnum()
        if start < end and apart and plausible(text[start:end], kind):
            out.append((start, end, kind))
    return out


def find_all(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text. Windows of all texts are decoded together.

    First those with an anchor, then those that a span found so far reaches into, until none
    is left: every plausible span comes out as if all windows were decoded.
    """
    bases = [base_spans(t) for t in texts]
    found: list[list] = [[] for _ in texts]
    codes: dict[int, np.ndarray] = {}
    waiting: list[tuple[int, int]] = []
    if tagger is not None:
        for i, text in enumerate(texts):
            starts = anchored_windows(text)[0].tolist()
            if starts:
                codes[i] = padded(text)
                waiting += [(i, start) for start in starts]
    known = set(waiting)
    while waiting:
        now, waiting = waiting[:DECODED], waiting[DECODED:]
        decoded = tagger.decode(np.stack([codes[i][start : start + WINDOW] for i, start in now]))
        for (i, start), tags in zip(now, decoded, strict=True):
            spans = window_spans(start, tags)
            found[i] += spans
            for first, last, *_ in spans:
                reached = [w for s in window_starts(first, last, len(texts[i])) if (w := (i, s)) not in known]
                known.update(reached)
                waiting += reached
    return [(b, added_spans(t, b, f)) for t, b, f in zip(texts, bases, found, strict=True)]


def _found(tagger: Tagger | None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = find_all([t or "" for t in batch.column("text").to_pylist()], tagger)
            counts = [[sum(k == kind for *_, k in base) for base, _ in spans] for kind in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array([sha256(joined(base)) for base, _ in spans], pa.string()),
                    pa.array([joined(base + more) for base, more in spans], pa.string()),
                    pa.array([len(more) for _, more in spans], pa.int64()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return find


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans, n_added.

    Base spans come from the patterns; the tagger adds spans that touch none of them and
    hold what their kind must hold. It reads every window with a digit, an at sign or a
    spelled-out one, and all that the spans there reach into, which is wherever a span can
    be. Offsets are code points, ends exclusive. A null text is
    empty; an empty list has the hash of the empty string; null ids and repeated rows are
    rows like others; where no base span exists nothing is learned and nothing added. An empty
    table gives an empty result, and a text of any length is read whole. Only the id and the
    text are read.
    """
    tagger = train(docs, id_col, text_col)
    slim = with_package(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_found(tagger), SCHEMA)
