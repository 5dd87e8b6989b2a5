"""Exact duplicates by a tree of merged digest runs, in DataFrame operations only.

The rows of some partitions are a run: one record per digest, sorted. Runs meet in binomial
rounds: in round r those whose numbers differ in bit r alone are merged, and where both have a
digest, the two records, verified by a second hash, become one with the id that stays. After
log2(runs) rounds one run is left. Runs are exchanged once, by digest, so that every task
holds its range of all of them, sorted by digest and run; a round reads that order and keeps it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglark.llm.common import Stage, ascii_lower, attach, fresh, stage

#: Runs at the leaves of the merge tree, a power of two.
RUNS = 256
KEY = ["_digest", "_check"]


def _digests(text: Column) -> dict[str, Column]:
    """SHA-256 of the normalised text and, to verify it, an independent hash with the length."""
    text = ascii_lower(F.coalesce(text, F.lit("")))
    return {"_digest": F.unhex(F.sha2(text, 256)), "_check": F.xxhash64(text, F.length(text))}


def _leaf_runs(members: DataFrame) -> DataFrame:
    """One record per run and digest; each task combines its rows before it sends them."""
    return members.groupBy("_run", *KEY).agg(
        F.max(F.struct("_id", "_row")).alias("_keep"), F.count("*").alias("_n")
    )


def _merge_round(runs: DataFrame, bit: int) -> DataFrame:
    """Merge the runs whose numbers differ in ``bit`` alone; a digest then has one record in each such pair.

    A digest's records are neighbours, sorted by run, at most one in each of the runs that are
    left. So partners stand next to each other: the later one takes over what the earlier one
    holds, which goes.
    """
    of_digest = Window.partitionBy(*KEY).orderBy("_run")
    pair = F.shiftright("_run", bit + 1)

    def partner(step: Column) -> Column:
        return F.coalesce(F.shiftright(step, bit + 1) == pair, F.lit(False))

    met = runs.withColumns(
        {
            "_first": partner(F.lead("_run").over(of_digest)),
            "_second": partner(F.lag("_run").over(of_digest)),
            "_keep0": F.lag("_keep").over(of_digest),
            "_n0": F.lag("_n").over(of_digest),
        }
    )
    return met.where(~F.col("_first")).select(
        "_run",
        *KEY,
        F.when(F.col("_second"), F.greatest("_keep", "_keep0")).otherwise(F.col("_keep")).alias("_keep"),
        F.when(F.col("_second"), F.col("_n") + F.col("_n0")).otherwise(F.col("_n")).alias("_n"),
    )


def merge_runs(members: DataFrame, runs: int = RUNS) -> DataFrame:
    """The final run: one record per digest, from ``members`` (_run, KEY, _id, _row).

    A digest that a third of all rows have is one record of each run before it is exchanged.
    """
    if runs < 1 or runs & (runs - 1):
        raise ValueError("runs must be a power of two")
    level = _leaf_runs(members)
    for bit in range(runs.bit_length() - 1):
        level = _merge_round(level, bit)
    return level.drop("_run")


def _members(docs: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("_id"),
        F.monotonically_increasing_id().alias("_row"),
        (F.spark_partition_id() % runs).alias("_run"),
        *[c.alias(n) for n, c in _digests(F.col(text_col)).items()],
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after lower-casing A-Z. Of equal texts the row with the
    largest id stays. A null text counts as empty; a null id is smaller than any other; of
    rows with the same id and text one stays. An empty table gives an empty result; other
    columns are not read, whatever their names.
    """
    members = stage(_members(docs, id_col, text_col, runs), "digest-runs")
    groups = stage(merge_runs(members, runs), "digest-groups")
    return attach(members, groups, KEY, "_n").select(
        F.col("_id").alias("doc_id"),
        F.col("_keep._id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_keep._row") == F.col("_row")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns.

    Rows with the same id and text collapse before the shuffle. Of equal texts under
    several ids only the row with the largest id is found among the kept ones.
    """
    members = Stage(_members(docs, id_col, text_col, RUNS), "digest-runs")
    keep = stage(
        merge_runs(members.df).select(
            F.xxhash64("_keep._id").alias("_key"), F.col("_digest").alias("_sum")
        ),
        "digest-kept",
    )
    members.drop()
    key, digest = fresh(docs, "_key", "_sum")
    marked = docs.withColumns(
        {key: F.xxhash64(id_col), digest: _digests(F.col(text_col))["_digest"]}
    ).dropDuplicates([key, digest])
    on = [marked[key] == keep["_key"], marked[digest] == keep["_sum"]]
    return marked.join(keep, on, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
