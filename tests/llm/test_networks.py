"""The networks against plain loops: convolution and pooling, best tag sequences, and gradients by differences."""

import itertools

import numpy as np
import pytest

from loglark.llm import language, pii_tagger


def test_convolution_pooling_and_softmax():
    rng = np.random.default_rng(3)
    net = language.ByteNet(["a", "b", "c"], seed=5)
    net.shift = rng.normal(size=net.shift.shape).astype(np.float32)
    x = language.windows("Some text, größer and naïve. " * 12)
    got = net.pooled(x, net.tables())
    for w in (0, len(x) - 1):
        for f in range(0, len(language._WIDTH), 7):
            width = int(language._WIDTH[f])
            best = max(
                sum(float(net.byte[x[w, at + k]] @ net.filter[k, :, f]) for k in range(width))
                for at in range(language.WINDOW)
            )
            assert got[w, f] == pytest.approx(max(best + float(net.shift[f]), 0), abs=1e-3)
    z = got @ net.dense + net.bias
    want = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    assert np.allclose(net.log_softmax(got), want, atol=1e-4)
    assert np.allclose(np.exp(net.log_softmax(got)).sum(axis=1), 1, atol=1e-5)


def test_windows_hold_every_byte_once():
    for text in ("", "A", "x" * 128, "é" * 200, "word " * 1000):
        x = language.windows(text)[:, : language.WINDOW].ravel()
        raw = text.encode().lower()
        assert bytes(x[: len(raw)]) == raw and not x[len(raw) :].any()


def test_best_tag_sequences(monkeypatch):
    monkeypatch.setattr(pii_tagger, "WINDOW", 4)
    rng = np.random.default_rng(1)
    tagger = pii_tagger.Tagger(seed=2)
    n = pii_tagger.TAGS
    tagger.step, tagger.first = rng.normal(size=(n, n)), rng.normal(size=n)
    codes = rng.integers(0, pii_tagger.CODES, (3, 4))
    e = tagger.emissions(codes)[0]
    got = tagger.decode(codes)
    for w in range(3):
        score = {
            tags: tagger.first[tags[0]] + sum(e[i, w, t] for i, t in enumerate(tags)) + sum(tagger.step[a, b] for a, b in zip(tags, tags[1:]))
            for tags in itertools.product(range(n), repeat=4)
        }
        assert tuple(got[w]) == max(score, key=score.get)


def test_gradients_of_the_tagger(monkeypatch):
    """Both directions of the network and the chain above it, parameter by parameter."""
    monkeypatch.setattr(pii_tagger, "WINDOW", 3)
    rng = np.random.default_rng(7)
    tagger = pii_tagger.Tagger(seed=4)
    n = pii_tagger.TAGS
    tagger.step, tagger.first = rng.normal(size=(n, n)), rng.normal(size=n)
    owners = {"tagger": tagger, "forward": tagger.forward, "backward": tagger.backward}
    for owner in owners.values():
        for name, value in list(vars(owner).items()):
            if isinstance(value, np.ndarray):
                setattr(owner, name, value.astype(np.float64))
    codes, tags = rng.integers(0, pii_tagger.CODES, (2, 3)), rng.integers(0, n, (2, 3))

    def loss():
        e, total = tagger.emissions(codes)[0], 0.0
        for w in range(2):
            def score(t):
                return tagger.first[t[0]] + sum(e[i, w, x] for i, x in enumerate(t)) + sum(tagger.step[a, b] for a, b in zip(t, t[1:]))
            total += np.log(sum(np.exp(score(t)) for t in itertools.product(range(n), repeat=3))) - score(tuple(tags[w]))
        return total / 2

    grads = tagger._gradients(codes, tags)
    assert {o for o, _ in grads} == set(owners.values())
    for (owner, name), g in grads.items():
        weight = getattr(owner, name)
        # Of the letters only those that the windows hold have a gradient.
        places = [(int(codes[0, 1]), 2), (int(codes[1, 0]), 0)] if name == "embed" else [tuple(rng.integers(0, s) for s in weight.shape) for _ in range(3)]
        for at in places:
            kept = weight[at]
            weight[at] = kept + 1e-4
            up = loss()
            weight[at] = kept - 1e-4
            down = loss()
            weight[at] = kept
            assert g[at] == pytest.approx((up - down) / 2e-4, abs=2e-4), (name, at)
