"""Near-duplicates against all pairs."""

from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from loglark.llm import minhash
from loglark.llm.shingles import fingerprint, shingles
from loglark.session import shared_folder
from tests.llm.conftest import DOCS, sentence


def word_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows):
    sets, root = {i: word_set(t) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(rng):
    rows = []
    for _ in range(12):
        base = sentence(rng, rng.choice([3, 30, 120, 400])).split()
        for _ in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = sentence(rng, 1)
            rows.append(rng.choice([str.upper, str.lower])(" ".join(words)))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_equal_all_pairs(spark, rng):
    rows = near_copies(rng)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_a_group_over_several_blocks(spark, rng, monkeypatch):
    base = sentence(rng, 150).split()
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(150)] = sentence(rng, 1)
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == brute(rows)


def test_odd_rows(odd, odd_rows, empty):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].component_id == by_id[2].component_id == 1
    assert [by_id[i].n_shingles for i in (3, 4, 6)] == [0, 0, 0] and by_id[3].kept
    assert (by_id[7].n_shingles, by_id[8].component_id) == (1, 8)
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} >= {1, 3, 4, 5}


def test_shingles_follow_the_words():
    for a, b, same in [("A b c d e", "a  B\tc\nd e", True), ("a b c d", "a b c d e", False), ("É b c d e", "é b c d e", False), ("a\x0bb", "a b", True), ("a\xa0b", "a b", False)]:
        assert (fingerprint(shingles(a)) == fingerprint(shingles(b))) == same
    assert len(shingles("x " * 100)) == 1 and len(shingles(None)) == len(shingles(" \n")) == 0


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, (20_000, minhash.HASHES), dtype=np.uint16)
    for similarity, least, most in ((0.85, 0.9999, 1.0), (0.5, 0.0, 0.001)):
        b = np.where(rng.random(a.shape) < similarity, a, a ^ 1)
        assert least <= len(minhash.surviving(a, b)) / len(a) <= most


def test_only_ids_that_go_stay_written(spark, rng):
    """What the stage wrote on the way used to lie beside every later stage of the pipeline."""
    rows = near_copies(rng)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    shared = Path(shared_folder(spark))
    before = set(shared.iterdir())
    kept = {r.doc_id for r in minhash.drop_near_duplicates(docs).collect()}
    assert kept == {i for i, (_, least) in brute(rows).items() if i == least}
    assert [p.name.rpartition("-")[0] for p in set(shared.iterdir()) - before] == ["near-gone"]


def test_bitmaps_lose_no_wanted_row(spark, monkeypatch):
    docs = spark.range(-5_000, 45_000).selectExpr("id as doc_id", "'x' as text", "'x' as _at")
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    wanted = docs.where("doc_id % 10 = 0 or doc_id is null").select(F.col("doc_id").alias("first_id"))
    for most, limit in ((minhash.MOST_BITS, 10_000), (minhash.BITMAP, 20_000)):
        monkeypatch.setattr(minhash, "MOST_BITS", most)
        marked = minhash._likely(docs, wanted, "doc_id", "first_id", "likely")
        assert marked.count() == docs.count() and marked.columns == [*docs.columns, "likely"]
        passed = marked.where("likely")
        assert passed.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id"))).count() == wanted.count()
        assert passed.count() < limit


def test_an_id_kept_for_one_text_stays_with_all(spark, rng):
    """Rows go by id; only those that may go are shuffled, the others come from the scan."""
    a, b = sentence(rng, 60), sentence(rng, 60)
    rows = [(1, a), (2, a), (2, b), (3, b), (None, a), (None, "alone here"), (4, None), (5, "alone too")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = minhash.drop_near_duplicates(docs)
    assert {(r.doc_id, r.text) for r in kept.collect()} == set(rows) - {(3, b)} and kept.count() == 7
    many = spark.range(40_000).selectExpr("id as doc_id", "concat('some text of number ', id div 2, ' and more words') as text", "'en' as lang")
    assert {r.doc_id for r in minhash.drop_near_duplicates(many).select("doc_id").collect()} == set(range(0, 40_000, 2))
