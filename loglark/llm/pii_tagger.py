"""A bidirectional LSTM over characters with a CRF on top, trained and run in numpy."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from loglark.llm.pii_rules import ANCHOR, KINDS, Span

#: Characters of a window and how far the next one starts; every character is in two windows.
WINDOW, STEP = 64, 32
#: Tags: outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
CODES = 76
EMBED, HIDDEN = 8, 16
EPOCHS, BATCH, RATE = 3, 64, 0.01


def _table() -> np.ndarray:
    """Codes of ASCII characters: letters by themselves without case, 1 beyond ASCII, 0 for padding."""
    table = np.ones(129, dtype=np.uint8)
    for i in range(128):
        c = chr(i).lower()
        table[i] = 2 + (ord(c) - 33 if 33 <= ord(c) < 65 else ord(c) - 91 + 32 if ord(c) >= 91 else 70 + (c == "\n"))
    return table


_CODE = _table()
assert _CODE.max() < CODES


def coded(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _CODE[np.minimum(points, 128)]


def padded(text: str) -> np.ndarray:
    return np.concatenate([coded(text), np.zeros(WINDOW, dtype=np.uint8)])


def window_starts(start: int, end: int, size: int) -> range:
    """Starts of all windows of a text of ``size`` that share a character with a span."""
    return range(max((start - WINDOW) // STEP + 1, 0) * STEP, min(end, size), STEP)


def anchored_windows(text: str, spans: Iterable[Span] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Starts and codes of the windows that hold an anchor, without which no span is plausible, or a part of ``spans``."""
    points = np.fromiter((m.start() for m in ANCHOR.finditer(text)), dtype=np.int64)
    more = [s for start, end, _ in spans for s in window_starts(start, end, len(text))]
    if not len(points) and not more:
        return points, np.zeros((0, WINDOW), dtype=np.uint8)
    at = np.concatenate([points // STEP, np.maximum(points // STEP - 1, 0)]) * STEP
    at = np.unique(np.concatenate([at, np.array(more, dtype=np.int64)]))
    return at, padded(text)[at[:, None] + np.arange(WINDOW)]


def tags_of(spans: list[Span], size: int) -> np.ndarray:
    out = np.zeros(size + WINDOW, dtype=np.uint8)
    for start, end, kind in spans:
        if not out[start:end].any():
            out[start], out[start + 1 : end] = 1 + 2 * kind, 2 + 2 * kind
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction; arrays are (time, window, ...)."""

    def __init__(self, rng: np.random.Generator) -> None:
        self.x = rng.normal(0, 0.25, (EMBED, 4 * HIDDEN)).astype(np.float32)
        self.h = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, dtype=np.float32)
        self.b[HIDDEN : 2 * HIDDEN] = 1

    def run(self, inputs: np.ndarray, keep: list | None = None) -> np.ndarray:
        t, n, _ = inputs.shape
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        pre, out = inputs.reshape(t * n, -1) @ self.x + self.b, np.empty((t, n, HIDDEN), np.float32)
        pre = pre.reshape(t, n, -1)
        for i in range(t):
            z = pre[i] + h @ self.h
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, last = c, h
            c = gates[:, HIDDEN : 2 * HIDDEN] * c + gates[:, :HIDDEN] * g
            squashed = np.tanh(c)
            h = gates[:, 2 * HIDDEN :] * squashed
            out[i] = h
            if keep is not None:
                keep.append((gates, g, before, squashed, last))
        return out

    def back(self, inputs: np.ndarray, keep: list, d_out: np.ndarray) -> tuple[np.ndarray, dict]:
        t, n, _ = inputs.shape
        dz = np.empty((t, n, 4 * HIDDEN), np.float32)
        dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        g_h = np.zeros_like(self.h)
        for i in range(t - 1, -1, -1):
            gates, g, before, squashed, last = keep[i]
            get, forget, give = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            dh = dh + d_out[i]
            dc = dc + dh * give * (1 - squashed**2)
            dz[i] = np.concatenate(
                [dc * g * get * (1 - get), dc * before * forget * (1 - forget), dh * squashed * give * (1 - give), dc * get * (1 - g**2)],
                axis=1,
            )
            g_h += last.T @ dz[i]
            dh, dc = dz[i] @ self.h.T, dc * forget
        flat = dz.reshape(t * n, -1)
        grads = {"x": inputs.reshape(t * n, -1).T @ flat, "h": g_h, "b": flat.sum(0)}
        return (flat @ self.x.T).reshape(inputs.shape), grads


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    def __init__(self, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.5, (CODES, EMBED)).astype(np.float32)
        self.forward, self.backward = Lstm(rng), Lstm(rng)
        self.out = rng.normal(0, 0.2, (2 * HIDDEN, TAGS)).astype(np.float32)
        self.bias = np.zeros(TAGS, np.float32)
        self.step = np.zeros((TAGS, TAGS), np.float32)
        self.first = np.zeros(TAGS, np.float32)

    def emissions(self, codes: np.ndarray, keep: tuple[list, list] | None = None) -> tuple[np.ndarray, ...]:
        x = self.embed[codes.T]
        kf, kb = keep or (None, None)
        h = np.concatenate([self.forward.run(x, kf), self.backward.run(x[::-1], kb)[::-1]], axis=2)
        return h @ self.out + self.bias, h, x

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of tags (time, window, tag), the sum over places of pairs of tags, and of first tags."""
        t, n, _ = e.shape
        up, down = np.empty_like(e), np.zeros_like(e)
        up[0] = self.first + e[0]
        for i in range(1, t):
            up[i] = _logsum(up[i - 1][:, :, None] + self.step, 1) + e[i]
        for i in range(t - 2, -1, -1):
            down[i] = _logsum(self.step + (e[i + 1] + down[i + 1])[:, None, :], 2)
        total = _logsum(up[-1], 1)[:, None]
        p = np.exp(up + down - total)
        pairs = np.zeros_like(self.step)
        for i in range(1, t):
            pairs += np.exp(
                up[i - 1][:, :, None] + self.step + (e[i] + down[i])[:, None, :] - total[:, :, None]
            ).sum(axis=0)
        return p, pairs, p[0].sum(axis=0)

    def _gradients(self, codes: np.ndarray, tags: np.ndarray) -> dict[tuple, np.ndarray]:
        """Of the mean negative log-likelihood: expected minus seen, back through the network."""
        n, gold = len(codes), tags.T
        keep: tuple[list, list] = ([], [])
        e, h, x = self.emissions(codes, keep)
        p, pairs, first = self.marginals(e)
        np.subtract.at(pairs, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        np.subtract.at(first, gold[0], 1)
        t = np.arange(WINDOW)[:, None]
        p[t, np.arange(n), gold] -= 1
        p /= n
        dh = p @ self.out.T
        dx, gf = self.forward.back(x, keep[0], dh[:, :, :HIDDEN])
        dxb, gb = self.backward.back(x[::-1], keep[1], dh[::-1, :, HIDDEN:])
        dx = dx + dxb[::-1]
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, codes.T.ravel(), dx.reshape(-1, EMBED))
        flat = p.reshape(-1, TAGS)
        grads = {
            (self, "out"): h.reshape(-1, 2 * HIDDEN).T @ flat,
            (self, "bias"): flat.sum(0),
            (self, "step"): pairs / n,
            (self, "first"): first / n,
            (self, "embed"): d_embed,
        }
        return grads | {(o, k): g for o, gs in ((self.forward, gf), (self.backward, gb)) for k, g in gs.items()}

    def train(self, codes: np.ndarray, tags: np.ndarray, seed: int = 0) -> None:
        rng, moments, t = np.random.default_rng(seed), {}, 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(codes))
            for i in range(0, len(order), BATCH):
                rows, t = order[i : i + BATCH], t + 1
                for (owner, name), g in self._gradients(codes[rows], tags[rows]).items():
                    m, v = moments.setdefault((owner, name), (np.zeros_like(g), np.zeros_like(g)))
                    m += 0.1 * (np.clip(g, -1, 1) - m)
                    v += 0.001 * (g * g - v)
                    step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
                    setattr(owner, name, (getattr(owner, name) - step).astype(np.float32))

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tag sequence of each window."""
        e = self.emissions(codes)[0]
        score, ways = self.first + e[0], []
        for i in range(1, WINDOW):
            total = score[:, :, None] + self.step
            ways.append(total.argmax(axis=1))
            score = total.max(axis=1) + e[i]
        rows = np.arange(len(codes))
        tags = np.empty((WINDOW, len(codes)), dtype=np.int64)
        tags[-1] = score.argmax(axis=1)
        for i in range(WINDOW - 2, -1, -1):
            tags[i] = ways[i][rows, tags[i + 1]]
        return tags.T


def window_spans(start: int, tags: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """Spans of one window in the text's offsets, and whether an edge of the window may have cut them."""
    out, i = [], 0
    while i < len(tags):
        if not tags[i]:
            i += 1
            continue
        kind, j = (int(tags[i]) - 1) // 2, i + 1
        while j < len(tags) and tags[j] == 2 + 2 * kind:
            j += 1
        out.append((start + i, start + j, kind, i == 0 or j == len(tags)))
        i = j
    return out


def reconciled(found: list[tuple[int, int, int, bool]], size: int) -> list[Span]:
    """One list of spans from overlapping windows: spans of a kind that overlap are one.

    A piece that touches the edge of its window only counts as part of a span that another
    window shows, or together with the piece on the other side.
    """
    out: list[list] = []
    for start, end, kind, cut in sorted(found, key=lambda s: (s[2], s[0], s[1])):
        start, end = max(start, 0), min(end, size)
        cut = cut and start > 0 and end < size
        if out and out[-1][2] == kind and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
            out[-1][3] += 1
            out[-1][4] &= cut
        else:
            out.append([start, end, kind, 1, cut])
    return [(s, e, k) for s, e, k, n, cut in out if e > s and (n > 1 or not cut)]
