"""Hard negatives: packed products against plain ones, the whole search against loops and SQL."""

import random

import duckdb
import numpy as np
import pytest

from loglark.llm import hard_negatives
from loglark.llm.hard_negatives import mine, packed_products

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("size", [0, 1, 3, 200, 30_000, 2**24, 2**27])
@pytest.mark.parametrize("n", [1, 2, 7])
def test_packed_products_are_exact(size, n):
    rng = np.random.default_rng(size + n)
    a = rng.integers(-size, size + 1, (4, 64))
    b = rng.integers(-size, size + 1, (n, 64))
    assert (packed_products(a, b) == a.astype(object) @ b.T.astype(object)).all()


def test_extreme_components():
    for a, b in [(1, 1), (-1, 1), (1, -1), (-1, -1)]:
        x, y = np.full((2, 64), 256 * a), np.full((5, 64), 256 * b)
        assert (packed_products(x, y) == 64 * 256 * 256 * a * b).all()
    # Several candidates of one word with extremes next to each other.
    y = np.array([[255] * 64, [-256] * 64, [0] * 64, [255, -256] * 32])
    x = np.array([[255] * 64, [-256] * 64, [255, -256] * 32])
    assert (packed_products(x, y) == x @ y.T).all()


def plainly(rows, every=100):
    rows = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in np.array(v, np.float32)])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, label, v) in enumerate(rows):
        if anchor % every:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), i, l) for b, (i, l, w) in enumerate(rows) if a != b]
        positives = sorted((s, i) for s, i, l in scored if l == label)[:5]
        for ps, p in positives:
            near = sorted((s, i) for s, i, l in scored if l != label and 80 * -ps <= 100 * -s <= 100 * -ps)[:5]
            out += [(anchor, p, k, i, -ps, -s) for k, (s, i) in enumerate(near, 1)]
    return sorted(out)


def make(n, seed, d=8):
    rng = random.Random(seed)
    pool = [[rng.gauss(0, 0.4) for _ in range(d)] for _ in range(40)]
    near = [[x + rng.gauss(0, 0.05) for x in rng.choice(pool)] for _ in range(n - n // 3)]
    return [(i, v, rng.randint(0, 9)) for i, v in enumerate(near + [rng.choice(pool) for _ in range(n // 3)])]


@pytest.mark.parametrize("cells", [(1024, 16_384), (3, 50)])
def test_equal_to_loops_and_sql(spark, monkeypatch, cells):
    monkeypatch.setattr(hard_negatives, "CELL_ANCHORS", cells[0])
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", cells[1])
    rows = make(700, 3)
    rng = random.Random(1)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, mine(df).collect()))
    assert got and got == plainly(rows)
    connection = duckdb.connect()
    connection.register("embeddings", df.toArrow())
    assert got == sorted(connection.execute(hard_negatives.SQL).fetchall())


def test_rows_that_take_no_part(spark):
    good = make(210, 8)
    v = good[0][1]
    bad = [(300, None, 1), (301, v, None), (None, v, 1), (303, [*v[:-1], None], 1), (304, [*v[:-1], float("nan")], 1), (305, [float("inf"), *v[1:]], 1)]
    df = spark.createDataFrame(good + bad, SCHEMA)
    assert sorted(map(tuple, mine(df).collect())) == plainly(good)


def test_repeated_rows_ties_and_lengths(spark):
    rows = make(250, 4) * 2 + [(1000, [0.5, 0.25], 3), (1001, [], 3), (1002, [0.0] * 8, 4)]
    got = sorted(map(tuple, mine(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == plainly(rows)


def test_one_label_or_none(spark):
    rows = [(i, [1.0, 0.0], 5) for i in range(1, 7)]
    assert mine(spark.createDataFrame(rows, SCHEMA)).collect() == []
    assert mine(spark.createDataFrame([], SCHEMA)).collect() == []
    rows.append((100, [1.0, 0.0], 5))
    assert mine(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_columns_with_clashing_names(spark):
    rows = make(220, 6)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'x' as `{c}`" for c in ("row", "id", "vec", "block", "slice", "score")])
    assert sorted(map(tuple, mine(df).collect())) == plainly(rows)
