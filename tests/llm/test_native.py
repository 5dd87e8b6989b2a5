"""Exact dedup, sharding and mixing against plain Python and SQL."""

import glob
import hashlib
import os
from collections import Counter, defaultdict

import duckdb
import pytest

from loglark.llm import exact_dedup, mixing, queries, sharding
from tests.llm.conftest import DOCS

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = queries.QUERIES[name](spark, DATA)
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in cursor.fetchall())
    assert sorted(repr([r[c] for c in sorted(names)]) for r in df.collect()) == want


def norm(text):
    return (text or "").translate(LOWER)


def test_exact_duplicates_of_odd_rows(odd, odd_rows):
    got = exact_dedup.exact_duplicates(odd, runs=8).collect()
    groups = defaultdict(list)
    for i, text, *_ in odd_rows:
        groups[hashlib.sha256(norm(text).encode()).hexdigest()].append(i)
    assert len(got) == len(odd_rows)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(groups.keys())


def test_drop_exact_duplicates(odd, odd_rows, empty):
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    rows = [(r.doc_id, norm(r.text)) for r in kept.collect()]
    assert len(rows) == len(set(t for _, t in rows)) == len({norm(t) for _, t, *_ in odd_rows})
    assert (2, "plain text of some words here") in rows
    assert exact_dedup.drop_exact_duplicates(empty).count() == 0
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_merge_keeps_the_hot_digest_whole(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same', cast(id as string)) as text")
    got = exact_dedup.exact_duplicates(docs.repartition(13)).where("group_size > 1").collect()
    assert len(got) == 2000 and {r.keep_id for r in got} == {5997} and sum(r.kept for r in got) == 1


@pytest.mark.parametrize("runs", [1, 2, 16, 256])
def test_rounds_keep_the_order_and_merge_pairs(spark, rng, runs):
    rows = [(rng.randrange(runs), bytes([rng.randrange(9)]), rng.randrange(2), i, i) for i in range(700)]
    members = spark.createDataFrame(rows, "_run int, _digest binary, _check long, _id long, _row long")
    want = defaultdict(list)
    for _, digest, check, i, _ in rows:
        want[bytes(digest), check].append(i)
    merged = exact_dedup.merge_runs(members, runs)
    assert {(bytes(r._digest), r._check): (r._keep._id, r._n) for r in merged.collect()} == {
        k: (max(v), len(v)) for k, v in want.items()
    }
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    rounds = runs.bit_length() - 1
    assert plan.count("Window ") >= rounds
    # One exchange makes the runs, one brings a digest's records together; rounds sort nothing again.
    assert plan.count("Exchange hashpartitioning") <= 2
    assert sum("Sort [_digest" in line for line in plan.splitlines()) <= 1
    level = exact_dedup._leaf_runs(members)
    for bit in range(rounds):
        level = exact_dedup._merge_round(level, bit)
        held = [(bytes(r._digest), r._check, r._run >> (bit + 1)) for r in level.collect()]
        assert len(held) == len(set(held))


def test_shards_fit_and_split_only_where_needed(spark, rng):
    rows = [(i, "x" * rng.randint(0, 200)) for i in range(3000)] + [(9999, "y" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sharding.shard(docs, limit=3000, step=3).collect()}
    size = {i: len(t) for i, t in rows}
    bits = {i: format(int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16), "032b") for i in size}
    sums, count = Counter(), Counter()
    for i, b in bits.items():
        for d in range(33):
            sums[b[:d]] += size[i]
            count[b[:d]] += 1
    for i, b in bits.items():
        depth = next(d for d in range(33) if sums[b[:d]] <= 3000 or count[b[:d]] == 1)
        r = got[i]
        assert (r.shard_depth, r.shard) == (depth, int(b[:depth] or "0", 2))
        assert (r.shard_bytes, r.shard_rows, r.n_bytes) == (sums[b[:depth]], count[b[:depth]], size[i])


def test_repeated_rows_are_split_too(spark, odd, odd_rows, empty):
    docs = spark.range(500).selectExpr("7L as doc_id", "repeat('z', 10) as text")
    got = sharding.shard(docs, limit=400).collect()
    assert len(got) == 500 and max(r.shard_bytes for r in got) <= 400
    assert sharding.shard(odd).count() == len(odd_rows)
    assert sharding.shard(empty).count() == 0


def test_mixing_moves_shortages_to_siblings_first(spark):
    rows = [(i, "w " * 10, "en" if i < 300 else "de", "src1" if i < 290 else "src6", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs, {"lang": "lang", "source": "source"}, {"lang": {"en": 3}}, share=0.5, max_epochs=1).collect()
    tokens = Counter()
    for r in got:
        tokens[(r.mix_lang, r.mix_source)] += r.mix_tokens
    # 2000 tokens: 1500 for en, of which src6 has 100 and src1 takes the rest; 500 for de
    assert tokens == {("en", "src1"): 1400, ("en", "src6"): 100, ("de", "src6"): 500}
    assert {r.mix_epoch for r in got} == {0}


def test_mixing_repeats_short_leaves_in_epochs(spark):
    rows = [(i, "w " * 5, "en", "src1" if i < 90 else "src2", 1) for i in range(100)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), {"source": "source"}, {}, max_epochs=3).collect()
    times = Counter((r.mix_source, r.mix_epoch) for r in got)
    assert times[("src2", 0)] == times[("src2", 1)] == times[("src2", 2)] == 10
    assert times[("src1", 0)] == 70 and len(got) == 100


def test_mixing_of_odd_rows(odd, empty):
    got = mixing.mix(odd)
    assert "x" not in {str(r.mix_epoch) for r in got.collect()}
    assert mixing.mix(empty).count() == 0


def test_written_shards_with_repeated_and_null_ids(spark, tmp_path):
    rows = [(1, f"{i % 3}" * 500, "en", "s", 1) for i in range(12)] + [(None, "n" * 400, "en", "s", 1)] * 8 + [(i, "t" * 300, "en", "s", 1) for i in range(20)]
    path = str(tmp_path / "shards")
    sharding.write_shards(spark.createDataFrame(rows, DOCS).repartition(3), path, limit=1000)
    got = spark.read.parquet(path).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(rows)
    sizes = defaultdict(list)
    for r in got:
        sizes[r.shard].append(len(r.text))
    assert all(sum(n) <= 1000 or len(n) == 1 for n in sizes.values())
