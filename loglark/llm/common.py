"""Helpers the operators of this folder share."""

from __future__ import annotations

import zipfile
from collections.abc import Sequence
from io import BytesIO
from pathlib import Path
from tempfile import mkdtemp

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglark.session import new_folder

#: ASCII white space, the only characters between words.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: So many of the largest groups are treated as hot. Groups outside them hold at most
#: 1 / HOT_GROUPS of all rows each, whatever the data, so no task gets more of one key.
HOT_GROUPS = 1024


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


class Stage:
    """A table written to the shared folder: survives lost executors, keeps its statistics.

    ``df`` reads it. ``drop`` deletes the files once nothing reads them any more; what a
    returned frame still reads stays until the job clears the shared folder.
    """

    def __init__(self, df: DataFrame, name: str) -> None:
        self.spark = df.sparkSession
        self.path = new_folder(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    return Stage(df, name).df


def with_package(df: DataFrame) -> DataFrame:
    """``df``, after sending this package to the executors, whose Python need not have it installed."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_loglark_sent", False):
        top = Path(__file__).resolve().parents[1]
        archive = BytesIO()
        with zipfile.ZipFile(archive, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, p.relative_to(top.parent))
        path = Path(mkdtemp(prefix="loglark-"), "loglark.zip")
        path.write_bytes(archive.getvalue())
        context.addPyFile(str(path))
        context._loglark_sent = True
    return df


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are. ``lower`` is the fast way where they agree."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def attach(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Inner join of ``rows`` with one row per group, whose row count is in column ``size``.

    The HOT_GROUPS largest groups are broadcast, a fixed number of rows, so their members
    never meet in one task. The others are joined by shuffle.
    """
    keys = list(keys)
    hot = groups.where(F.col(size) > 1).orderBy(F.desc(size), *keys).limit(HOT_GROUPS)
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(cold.join(groups, keys))


def smallest_hashes(rows: DataFrame, group: str, key: str, per_group: int) -> DataFrame:
    """Of each ``group`` the ``per_group`` rows whose ``key`` hashes smallest; a written table.

    Groups are counted first, and only rows below a hash that about twice as many rows are
    expected to pass are ranked, so a task ranks that many however large its group is.
    """
    sizes = stage(rows.groupBy(group).agg(F.count("*").alias("_size")), "sample-sizes")
    place = F.xxhash64(key)
    share = F.lit(2.0 * per_group + 50) / F.col("_size")
    likely = (
        rows.join(sizes, group)
        .withColumn("_place", place)
        .where((F.shiftrightunsigned("_place", 1) / F.lit(float(1 << 63))) < share)
    )
    order = Window.partitionBy(group).orderBy(F.shiftrightunsigned("_place", 1), key)
    ranked = likely.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= per_group)
    return stage(ranked.drop("_size", "_place", "_nth"), "sample")
