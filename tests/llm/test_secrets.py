"""Secret scans: base spans against plain patterns, the battery against plain loops, all against SQL."""

import hashlib
import math
import random
import re
import string

import duckdb
import pytest

from loglark.llm import secret_scan
from loglark.llm.secret_scan import secrets

# The contract's own patterns, lengths checked after the scan.
BASE = (
    (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("AKIA[A-Z0-9]+", 0, 16),
    ("[0-9a-f]+", 0, 32),
)
B64 = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"
HEXES = "0123456789abcdef"


def plain_spans(text):
    out = []
    for kind, (pattern, group, least) in enumerate(BASE):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, re.A) if len(m[group]) >= least]
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(out))


def rows_of(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in secrets(df, **more).collect()}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)

    def run(symbols, n):
        return "".join(rng.choice(symbols) for _ in range(n))

    words = "How To Build House Order Http Server Request Parser Abstract Factory Bean Proxy".split()
    return [
        *[f"see {run(B64, rng.choice([40, 64, 88]))} there" for _ in range(40)],
        *[f'Token = "{run(HEXES, 40)}", then {run(B64, 60)}' for _ in range(20)],
        *[f"naïve — 😀 {run('0123456789ABCDEF', 64)}" for _ in range(20)],
        *["x " + "".join(rng.choice(words) for _ in range(6)) + " y" for _ in range(60)],
        *["x " + "-".join(rng.choice(words).lower() for _ in range(6)) + str(rng.randint(1, 99)) for _ in range(60)],
    ]


def test_base_spans_follow_the_patterns(spark):
    rng = random.Random(3)
    pieces = [
        "password", "PassWd", "secret", "token", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "\n", "é", "😀", "ſecret",
        "AKIA", "ABCD1234EFGH", "AKIAABCDEFGHIJKL", "deadbeef" * 4, "0" * 31, "abcdefgh", "abc", "x.y=z/", "", "", "toKen",
    ]
    cases = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(600)]
    cases += ["token: secret: longvalue123", "token == abcdefgh", "secret=" + "a" * 50_000, "AKIA" * 5_000, ""]
    found = rows_of(spark, cases)
    for i, text in enumerate(cases):
        want = plain_spans(text)
        assert found[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        assert [found[i].n_assign, found[i].n_access, found[i].n_hex] == [want.count(f"{k}:") for k in secret_scan.KINDS[:3]]
        assert set(filter(None, want.split(","))) <= set(found[i].spans.split(","))


def test_battery_against_plain_loops(spark):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    runs = ["".join(rng.choice(B64) for _ in range(n)) for n in (20, 33, 64, 200)] + ["abcDEF012" * 4]
    df = spark.createDataFrame([(r,) for r in runs], "r string")
    for row in df.select("r", *[z.alias(f"z{i}") for i, z in enumerate(secret_scan._battery(F.col("r"), B64))]).collect():
        v, n, k = [B64.index(c) for c in row.r], len(row.r), 64
        chi = sum((v.count(s) - n / k) ** 2 / (n / k) for s in range(k))
        z0 = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
        runs_seen = 1 + sum((a < 32) != (b < 32) for a, b in zip(v, v[1:]))
        z1 = (runs_seen - 1 - (n - 1) / 2) / math.sqrt((n - 1) / 4)
        z2 = sum((a - 31.5) * (b - 31.5) for a, b in zip(v, v[1:])) / (math.sqrt(n - 1) * (k * k - 1) / 12)
        assert [row.z0, row.z1, row.z2] == pytest.approx([z0, z1, z2])


def test_random_runs_are_found_and_written_ones_left(spark, texts):
    found = rows_of(spark, texts)
    right = [found[i].n_random for i in range(len(texts))]
    assert sum(right[:80]) >= 72 and sum(right[80:]) == 0
    text, row = texts[0], found[0]
    if row.n_random:
        kind, start, end = row.spans.split(":")
        assert kind == "random" and text[int(start) : int(end)] == text.split()[1]


def test_length_decides_under_one_share_of_false_reports(spark):
    rng = random.Random(11)
    short = ["".join(rng.choice(B64) for _ in range(20)) for _ in range(30)]
    long = ["".join(rng.choice(B64) for _ in range(100)) for _ in range(30)]
    found = rows_of(spark, short + long)
    assert sum(found[i].n_random for i in range(30, 60)) >= 28
    assert sum(found[i].n_random for i in range(30)) < 28


@pytest.mark.parametrize("text", [
    "abcdefghijklmnopqrstuvwxyz0123456789", B64, "550e8400-e29b-41d4-a716-446655440000", "z" * 300_000, "1" * 31,
    "4111111111111111111111111111", "Donaudampfschifffahrtsgesellschaftskapitaen",
])
def test_ordered_and_numeric_runs_are_no_secrets(spark, text):
    assert rows_of(spark, [text])[0].spans == ""


def test_odd_rows(spark, odd, empty):
    assert secrets(empty).collect() == []
    rows = secrets(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in rows)


def test_equal_to_sql(spark, texts):
    df = spark.createDataFrame([(i % 90, t) for i, t in enumerate([*texts, None, "", "token=abcdefgh"])], "doc_id long, text string")
    got = sorted(map(tuple, secrets(df).collect()))
    documents = df.toPandas()
    connection = duckdb.connect()
    connection.register("documents", documents)
    assert got == sorted(connection.execute(secret_scan.SQL).fetchall())


def test_only_native_operations(spark):
    df = spark.createDataFrame([(1, "token=abcdefgh " + "Ab3+" * 10)], "doc_id long, text string")
    plan = secrets(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
