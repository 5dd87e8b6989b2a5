"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglark.llm.common import Stage, fresh, stage

SHARD_BYTES = 16 << 20
#: Bits of the hash: first those of the id, then those of the row, which only rows of one id need.
ID_BITS, ROW_BITS = 32, 28
BITS = ID_BITS + ROW_BITS
#: Bits that one pass adds to the directory.
STEP = 12


def _buckets(cells: DataFrame, low: int, high: int) -> DataFrame:
    """All buckets of ``low`` to ``high`` bits over cells of ``high`` bits, with their sizes."""
    depths = F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")
    return (
        cells.select("cell", "bytes", "rows", depths)
        .groupBy("depth", F.expr(f"shiftright(cell, {high} - depth)").alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    )


def _directory(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """For each cell of ``high`` bits its bucket: the first one on the way down that fits.

    Cells still too large at ``high`` bits get a null depth, unless no bit is left.
    """
    buckets = _buckets(cells, low, high).withColumn(
        "fits", (F.col("bytes") <= limit) | (F.col("rows") == 1) | (F.col("depth") == BITS)
    )
    way = cells.select("cell", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {high} - depth)")
    )
    first = F.min(F.when(F.col("fits"), F.struct("depth", "prefix", "bytes", "rows")))
    return way.join(buckets, ["depth", "prefix"]).groupBy("cell").agg(first.alias("b")).select("cell", "b.*")


def shard(
    docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", step: int = STEP
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, shard_depth, shard, shard_bytes, shard_rows.

    A shard is a bucket of hash-prefix bits (``shard`` are the first ``shard_depth`` bits as
    a number). A bucket over ``limit`` bytes of UTF-8 splits on one more bit, others stay as
    they are, until each fits. A single row over the limit is a shard of its own. Null texts
    have no bytes, null ids share a hash, repeated rows are told apart by the last bits; an
    empty table gives no shard; other columns are not read.

    Rows are counted once into cells of ``step`` bits; all splits inside a cell are decided
    on these sums. Only rows of cells that are still too large are counted again.
    """
    return _shard(docs, limit, id_col, text_col, step, [])


def _shard(docs: DataFrame, limit: int, id_col: str, text_col: str, step: int, also: list[str]) -> DataFrame:
    """As ``shard``, with the columns ``also`` of each row."""
    rest = Stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
            F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, ID_BITS // 4), 16, 10)
            .cast("long")
            .alias("id_bits"),
            F.monotonically_increasing_id().alias("row"),
            *also,
        ).select(
            "doc_id",
            "n_bytes",
            *also,
            (
                F.shiftleft("id_bits", ROW_BITS)
                + F.shiftrightunsigned(F.xxhash64("row"), 64 - ROW_BITS)
            ).alias("hash"),
        ),
        "shard-rows",
    ).df
    done, low = [], 0
    while True:
        high = min(low + step, BITS)
        rows = rest.withColumn("cell", F.shiftright("hash", BITS - high))
        cells = rows.groupBy("cell").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows"))
        directory = stage(_directory(stage(cells, "shard-cells"), low, high, limit), "shard-directory")
        closed = directory.where("depth is not null")
        done.append(
            rows.join(closed, "cell").select(
                "doc_id",
                "n_bytes",
                F.col("depth").alias("shard_depth"),
                F.col("prefix").alias("shard"),
                F.col("bytes").alias("shard_bytes"),
                F.col("rows").alias("shard_rows"),
                *also,
            )
        )
        if high == BITS or directory.where("depth is null").isEmpty():
            return reduce(DataFrame.unionByName, done)
        rest = stage(
            rows.join(directory.where("depth is null").select("cell"), "cell", "left_semi").drop("cell"), "shard-rows"
        )
        low = high


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id") -> None:
    """Write the documents as Parquet, one folder per shard below ``path``.

    Rows are numbered and written to the shared folder first; their numbers join them to
    their shards, so ids can repeat or be null.
    """
    (row,) = fresh(docs, "_row")
    numbered = Stage(docs.withColumn(row, F.monotonically_increasing_id()), "shard-documents")
    places = _shard(numbered.df, limit, id_col, "text", STEP, [row])
    places = places.select(row, F.concat_ws("-", F.col("shard_depth"), F.col("shard")).alias("shard"))
    rows = numbered.df.join(places, row).drop(row)
    rows.repartition("shard").write.partitionBy("shard").parquet(path)
    numbered.drop()


SQL = f"""
with d as (
  select doc_id, cast(coalesce(strlen(text), 0) as bigint) as n_bytes,
         cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) as h
  from documents),
b as (
  select k.k as depth, h >> cast({ID_BITS} - k.k as int) as prefix, cast(sum(n_bytes) as bigint) as bytes, count(*) as rows
  from d cross join (select unnest(range(0, {ID_BITS} + 1)) as k) k group by all),
f as (
  select d.doc_id, d.n_bytes, b.depth, b.prefix, b.bytes, b.rows,
         row_number() over (partition by d.doc_id order by b.depth) as nth
  from d join b on b.prefix = d.h >> cast({ID_BITS} - b.depth as int)
  where b.bytes <= {SHARD_BYTES} or b.rows = 1)
select doc_id, n_bytes, cast(depth as int) as shard_depth, cast(prefix as bigint) as shard,
       bytes as shard_bytes, rows as shard_rows
from f where nth = 1
"""
