"""Near-duplicates: banded MinHash candidates, pruned by sequential Bayesian tests, verified exactly.

Texts with equal shingle sets are one node. Nodes that share a band meet in a bucket, and
each bucket compares its members with one centre, the member that meets most others, which
needs no pairs of members. Only members that this leaves in different components are
compared with each other, inside blocks of one centre's members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import Stage, attach, fresh, stage, with_package
from loglark.llm.shingles import fingerprint, shingles

#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: A pair at the threshold shares none of the bands with probability (1 - 0.85 ** 6) ** 32, 3e-7.
BANDS, ROWS = 32, 6
HASHES = BANDS * ROWS
#: Hashes compared at a time, and the probability at which a linked pair may be pruned.
BATCH, MISS = 32, 1e-6
#: Most members and hashes of a block of members that are compared with each other.
BLOCK_ROWS, BLOCK_HASHES = 2048, 2_000_000
#: Bits for each wanted id in the bitmaps that choose the texts to be shuffled, and most bits of them: 8 MB.
ID_BITS, MOST_BITS = 16, 1 << 26
#: Bits of one bitmap of Spark's bitmap functions.
BITMAP = 1 << 15

_rng = np.random.default_rng(20240229)
_FACTOR = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of the set under HASHES permutations, 16 bits of each: unequal ones agree once in 65,536."""
    low = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 256):
        np.minimum(low, (short[i : i + 256, None] * _FACTOR + _SHIFT).min(axis=0), out=low)
    return (low ^ (low >> np.uint32(16))).astype("<u2")


@lru_cache(maxsize=8)
def least_matches(n: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Fewest equal hashes of ``n`` at which the similarity may still reach the threshold.

    With a uniform prior the posterior after k matches is Beta(k + 1, n - k + 1); its mass
    above the threshold is a binomial sum. Fewer matches leave less than ``miss``.
    """
    t, mass = percent / 100, 0.0
    for k in range(n + 1):
        mass += exp(lgamma(n + 2) - lgamma(k + 1) - lgamma(n + 2 - k) + k * log(t) + (n + 1 - k) * log(1 - t))
        if mass >= miss:
            return k
    return n


def surviving(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indices of the rows (pairs of signatures) that no batch of hashes prunes."""
    left, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int32)
    for start in range(0, HASHES, BATCH):
        stop = start + BATCH
        matches = matches + (a[left, start:stop] == b[left, start:stop]).sum(axis=1)
        keep = matches >= least_matches(stop)
        left, matches = left[keep], matches[keep]
    return left


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Exact test on two sorted sets."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([fingerprint(s) for s in sets], pa.binary()),
                pa.array([signature(s).tobytes() for s in sets], pa.binary()),
            ],
            names=["doc_id", "n", "fp", "sig"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of the wanted fingerprints; ids can repeat, so the text must give that one."""
    for batch in batches:
        sets = [shingles(t.as_py()) for t in batch.column("text")]
        same = [i for i, (s, fp) in enumerate(zip(sets, batch.column("fp"), strict=True)) if fingerprint(s) == fp.as_py()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("fp").take(pa.array(same, pa.int64())), pa.array([sets[i].tobytes() for i in same], pa.binary())],
            names=["fp", "hashes"],
        )


def _prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def matrix(column) -> np.ndarray:
        return np.frombuffer(b"".join(x.as_py() for x in column), dtype="<u2").reshape(-1, HASHES)

    for batch in batches:
        left = surviving(matrix(batch.column("a_sig")), matrix(batch.column("b_sig")))
        yield batch.select(["a", "b"]).take(pa.array(left, pa.int64()))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("a_hashes"), batch.column("b_hashes"), strict=True)
        left = [i for i, (x, y) in enumerate(pairs) if linked(*(np.frombuffer(z.as_py(), dtype="<u8") for z in (x, y)))]
        yield batch.select(["a", "b"]).take(pa.array(left, pa.int64()))


def _link_block(rows: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Links between members of different components in one block, or between two blocks.

    Pairs are tested by signature first, best first on the full sets; those that earlier
    links have joined are not tested again.
    """
    sigs = np.frombuffer(b"".join(rows["sig"]), dtype="<u2").reshape(-1, HASHES)
    sets = [np.frombuffer(x, dtype="<u8") for x in rows["hashes"]]
    sizes, names = np.array([len(s) for s in sets]), rows["fp"].tolist()
    comps = np.unique(rows["comp"].to_numpy(dtype=object), return_inverse=True)[1]
    blocks, across = rows["block"].to_numpy(), bool(rows["low"].iloc[0] != rows["high"].iloc[0])
    root = list(range(int(comps.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for i in range(len(names) - 1):
        other = np.arange(i + 1, len(names))
        keep = comps[other] != comps[i]
        if across:
            keep &= blocks[other] != blocks[i]
        n = sizes[other]
        keep &= 100 * np.minimum(n, sizes[i]) >= PERCENT * np.maximum(n, sizes[i])
        other = other[keep]
        if not len(other):
            continue
        left = other[surviving(np.broadcast_to(sigs[i], (len(other), HASHES)), sigs[other])]
        for j in left[np.argsort(-(sigs[left] == sigs[i]).sum(axis=1), kind="stable")]:
            a, b = find(comps[i]), find(comps[j])
            if a != b and linked(sets[i], sets[j]):
                root[a] = b
                found.append((names[i], names[j]))
    return found


def _link_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(_link_block(rows), columns=["a", "b"])


def components(links: DataFrame) -> Stage:
    """``node``, ``comp``: the smallest node that links (a, b) reach, for every linked node.

    Each round takes the smallest label of the neighbours and then the label of that label.
    """
    both = Stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    last = Stage(both.df.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("comp")), "labels")
    while True:
        labels = last.df.select("node", "comp")
        near = (
            both.df.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("comp").alias("near"))
        )
        lower = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "comp", F.least("comp", "near").alias("low")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("comp").alias("far"))
        after = Stage(
            lower.join(jump, F.col("low") == F.col("via"), "left").select(
                "node", F.least("low", F.coalesce("far", "low")).alias("comp"), F.col("comp").alias("was")
            ),
            "labels",
        )
        last.drop()
        last = after
        if after.df.where("comp <> was").isEmpty():
            both.drop()
            return last


def _bands(nodes: DataFrame) -> DataFrame:
    keys = F.expr(
        f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, substring(sig, b * {2 * ROWS} + 1, {2 * ROWS})))"
    )
    return nodes.select("fp", F.explode(keys).alias("bucket"))


def _with(pairs: DataFrame, table: DataFrame, column: str, sides: str = "ab") -> DataFrame:
    for side in sides:
        right = table.select(F.col("fp").alias(side), F.col(column).alias(f"{side}_{column}"))
        pairs = pairs.join(right, side)
    return pairs


def _star_pairs(nodes: DataFrame) -> Stage:
    """(a, b): member and centre of every bucket that at least two nodes share."""
    bands = _bands(nodes)
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    buckets = Stage(bands.join(shared, "bucket"), "near-buckets")
    members = buckets.df
    meets = members.groupBy("fp").agg(F.sum("size").alias("meets"))
    centres = (
        members.join(meets, "fp")
        .groupBy("bucket")
        .agg(F.max(F.struct("meets", "fp")).alias("c"))
        .select("bucket", F.col("c.fp").alias("b"))
    )
    pairs = members.join(centres, "bucket").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    stars = Stage(pairs, "near-stars")
    buckets.drop()
    return stars


def _likely(docs: DataFrame, wanted: DataFrame, column: str, wanted_column: str, mark: str) -> DataFrame:
    """``docs`` with ``mark``: false only where ``wanted``, a written table, surely has no such value.

    The hashes of the wanted values are bits of bitmaps, ID_BITS a value, MOST_BITS at most. A
    hash that two values share marks the other too, so an exact join of the marked rows has to follow.
    """
    bits = BITMAP * min(-(-ID_BITS * max(wanted.count(), 1) // BITMAP), MOST_BITS // BITMAP)

    def place(name: str):
        return F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(bits)) + 1

    number, at, bitmap = fresh(docs, "_bitmap", "_at", "_bits")
    bitmaps = (
        wanted.select(place(wanted_column).alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias(number))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias(bitmap))
    )
    placed = docs.withColumn(at, place(column))
    placed = placed.withColumns({number: F.bitmap_bucket_number(at), at: F.bitmap_bit_position(at)})
    byte = F.expr(f"cast(conv(hex(substring(`{bitmap}`, cast(`{at}` div 8 + 1 as int), 1)), 16, 10) as long)")
    held = F.coalesce(F.getbit(byte, (F.col(at) % 8).cast("int")) == 1, F.lit(False))
    return placed.join(F.broadcast(bitmaps), number, "left").select(*[F.col(f"`{c}`") for c in docs.columns], held.alias(mark))


def _links_of_rest(stars: DataFrame, links: DataFrame, met: DataFrame, sets: DataFrame) -> Stage:
    """Links that centres do not show: between members of one centre in different components."""
    comps = components(links)
    members = stars.join(comps.df, F.col("a") == F.col("node"), "left").select(
        F.col("b").alias("centre"), F.col("a").alias("fp"), F.coalesce("comp", "a").alias("comp")
    )
    written = Stage(members.join(met.select("fp", "n"), "fp"), "near-members")
    members = written.df
    comps.drop()
    open_ = (
        members.groupBy("centre")
        .agg(
            F.min("comp").alias("first"),
            F.max("comp").alias("last"),
            F.greatest(
                F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_HASHES), F.lit(1)
            ).alias("blocks"),
        )
        .where("first <> last")
        .select("centre", "blocks")
    )
    rows = (
        members.join(open_, "centre")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "centre", "fp", "comp", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
        )
        .join(met.select("fp", "sig"), "fp")
        .join(sets, "fp")
    )
    found = Stage(rows.groupBy("centre", "low", "high").applyInPandas(_link_blocks, "a binary, b binary"), "near-links")
    written.drop()
    return found


def _groups(docs: DataFrame, id_col: str, text_col: str) -> tuple[Stage, Stage]:
    """All rows (doc_id, n, fp), and the nodes (fp, copies, component_id).

    Every other table that is written on the way is deleted as soon as no later step reads it.
    """
    slim = with_package(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = Stage(slim.mapInArrow(_sets, "doc_id long, n long, fp binary, sig binary"), "near-signatures")
    full = signed.df.where("n > 0")
    nodes = Stage(
        full.groupBy("fp").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig")
        ),
        "near-nodes",
    )
    rows = Stage(signed.df.select("doc_id", "n", "fp"), "near-rows")
    signed.drop()

    stars = _star_pairs(nodes.df)
    ends = stars.df.select("a").union(stars.df.select("b")).distinct().withColumnRenamed("a", "fp")
    met = Stage(ends.join(nodes.df.select("fp", "first_id", "n", "sig"), "fp"), "near-met")
    sets = Stage(
        _likely(slim, met.df, "doc_id", "first_id", "likely")
        .where("likely")
        .join(met.df.select("fp", "first_id"), F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("fp", "text")
        .mapInArrow(_full_sets, "fp binary, hashes binary")
        .dropDuplicates(["fp"]),
        "near-sets",
    )
    likely = _with(stars.df, met.df, "sig").mapInArrow(_prune, "a binary, b binary")
    links = Stage(_with(likely, sets.df, "hashes").mapInArrow(_verify, "a binary, b binary"), "near-links")
    rest = _links_of_rest(stars.df, links.df, met.df, sets.df)
    for done in (sets, stars, met):
        done.drop()

    comps = components(links.df.union(rest.df))
    grouped = nodes.df.select("fp", "first_id", "copies").join(comps.df.withColumnRenamed("node", "fp"), "fp", "left")
    smallest = grouped.where("comp is not null").groupBy("comp").agg(F.min("first_id").alias("least_id"))
    groups = Stage(
        grouped.join(smallest, "comp", "left").select(
            "fp", "copies", F.coalesce("least_id", "first_id").alias("component_id")
        ),
        "near-groups",
    )
    for done in (links, rest, comps, nodes):
        done.drop()
    return rows, groups


def _found(rows: DataFrame, groups: DataFrame) -> DataFrame:
    found = attach(rows.where("n > 0"), groups, ["fp"], "copies").select("doc_id", "n", "component_id")
    alone = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two texts are linked when 100 * intersection >= 85 * union of their sets of five-word
    shingles (A-Z in lower case, fewer words are one shingle). ``component_id`` is the
    smallest id that links reach, ``kept`` marks the row of that id. A text without words or
    a null text has an empty set and no links, like a row of its own; a null id is never the
    smallest but among null ids. Rows of one text stay together whatever their ids; an empty
    table gives an empty result; other columns are not read.
    """
    rows, groups = _groups(docs, id_col, text_col)
    return _found(rows.df, groups.df)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Of a group the rows with its smallest id stay: one, where ids are unique.
    """
    rows, groups = _groups(docs, id_col, text_col)
    key, mark = fresh(docs, "_gone_id", "_likely")
    # An id that is kept for one of its texts stays with all its rows.
    by_id = _found(rows.df, groups.df).groupBy(F.col("doc_id").alias(key)).agg(F.max("kept").alias("kept"))
    gone = stage(by_id.where("not kept").select(key), "near-gone")
    rows.drop()
    groups.drop()
    marked = _likely(docs, gone, id_col, key, mark)
    # Few rows go, as a rule: only those that may are shuffled.
    unsure = marked.where(F.col(mark))
    left = unsure.join(gone, unsure[id_col].cast("long").eqNullSafe(gone[key]), "left_anti")
    return marked.where(~F.col(mark)).unionByName(left).select(*[F.col(f"`{c}`") for c in docs.columns])
