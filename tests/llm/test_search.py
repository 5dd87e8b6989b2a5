"""Ranked search: terms, bounds and the first k against plain Python and SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from loglark.llm import lexical_search
from loglark.llm.lexical_search import TERM, Best, Shard, search, search_shard, terms_of

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plainly(docs, items, k=50):
    held = [(i, Counter(re.findall(TERM, lower(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        terms = set(re.findall(TERM, lower(text))) & set(df)
        scored = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms & set(c)
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, n, copies=0):
    rng = random.Random(seed)
    words = [f"w{int(400 * rng.random() ** 3)}" for _ in range(3000)] + ["Größe", "naïve", "日本", "x1"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    texts += [rng.choice(texts[:3]) for _ in range(copies)]
    items = [(i, " ".join(rng.choice(words) for _ in range(12)) if i % 3 else texts[i]) for i in range(15)]
    return list(enumerate(texts)), items


def found(spark, docs, items, **more):
    rows = search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **more).collect()
    return sorted(map(tuple, rows), key=repr)


def test_terms():
    text = "It's A-Z_é, 10x ÀÉ\x00\x7f~{}[]@` 😀b\ncafé x"
    assert [t.decode() for t in terms_of(text)] == re.findall(TERM, lower(text))
    assert terms_of(None) == terms_of("") == terms_of(" .,;\n") == []


@pytest.mark.parametrize("shard", [(8192, 2_000_000, 64), (100, 2_000_000, 4), (10_000, 500, 8)])
def test_equal_to_plain_and_sql(spark, monkeypatch, shard):
    for name, value in zip(("SHARD_ROWS", "SHARD_ENTRIES", "BLOCK"), shard, strict=True):
        monkeypatch.setattr(lexical_search, name, value)
    docs, items = corpus(2, 900, copies=300)
    want = plainly(docs, items)
    got = found(spark, docs, items)
    assert got == want and len(want) > 600
    connection = duckdb.connect()
    connection.register("documents", spark.createDataFrame(docs, DOCS).toArrow())
    connection.register("benchmark", spark.createDataFrame(items, ITEMS).toArrow())
    assert sorted(connection.execute(lexical_search.SQL).fetchall(), key=repr) == want


def test_passes_give_the_same(spark):
    docs, items = corpus(5, 200)
    assert found(spark, docs, items, pass_terms=20) == plainly(docs, items)


def shards(seed, n, n_terms=60):
    """Documents of six topics with ten terms each, and a few terms of any topic."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        topic = 10 * int(rng.integers(6))
        rows.append(np.unique(np.append(rng.choice(10, rng.integers(3, 9), replace=False) + topic, rng.choice(n_terms, 2))))
    terms = np.concatenate(rows)
    weight = np.random.default_rng(0).integers(50, 1000, n_terms)
    shares = weight[terms] * rng.integers(80, 100, len(terms))
    return Shard(np.arange(n), np.append(0, np.cumsum([len(r) for r in rows])), terms, shares, n_terms)


def test_summaries_bound_every_score_and_blocks_hold_every_document():
    shard = shards(1, 700)
    query = np.array([3, 8, 30, 44])
    scores = shard.scores(query)
    assert (shard.scores_of(np.arange(700), query, np.zeros(60, dtype=np.int64)) == scores).all()
    for term in (3, 30):
        docs, begins = shard.blocks(term)
        assert sorted(docs) == sorted(shard.docs(term)) and len(begins) > 1
        bound = shard.summaries(docs, begins)[:, query].sum(axis=1)
        for b, (at, end) in enumerate(zip(begins, np.append(begins[1:], len(docs)))):
            assert bound[b] >= scores[docs[at:end]].max()


def test_blocks_are_skipped_and_nothing_is_lost(monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", 16)
    rng = np.random.default_rng(4)
    best, queries = Best(20, 10), [np.sort(np.append(rng.choice(10, 4, replace=False) + 10 * (q % 6), 10 * ((q + 1) % 6))) for q in range(20)]
    every, blocks, read = [], 0, 0
    for seed in range(4):
        shard = shards(seed, 3000)
        shard.ids = shard.ids * 4 + seed
        b, r = search_shard(shard, queries, best)
        blocks, read = blocks + b, read + r
        every.append(shard)
    assert 0 < read < 0.8 * blocks
    for q, query in enumerate(queries):
        ids = np.concatenate([s.ids for s in every])
        scores = np.concatenate([s.scores(query) for s in every])
        first = np.lexsort((ids, -scores))[:10]
        assert (best.ids[q] == ids[first]).all() and (best.scores[q] == scores[first]).all()


def test_odd_rows(spark, odd, odd_rows, empty):
    items = [(1, "plain words here"), (None, "no id"), (2, None), (3, ""), (4, "absent everywhere"), (1, "É 123"), (1, "plain words here"), (5, "word")]
    df = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' as terms", "'x' as id")
    got = sorted(map(tuple, search(odd, df).collect()), key=repr)
    assert got == plainly([r[:2] for r in odd_rows], items)
    assert search(empty, df).collect() == []
    assert search(odd, df.limit(0)).collect() == []


def test_a_very_long_text_and_a_term_of_every_document(spark):
    docs = [(0, "the rare " * 200_000), *[(i, f"the w{i % 7}") for i in range(1, 400)], (400, "the")]
    items = [(1, "the"), (2, "the rare w3")]
    assert found(spark, docs, items) == plainly(docs, items)
