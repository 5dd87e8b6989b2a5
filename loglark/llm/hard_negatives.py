"""Hard negatives by exact products of packed integers.

Several candidates' components, biased to be at least 0, stand side by side in separated fields
of one wide integer. One multiplication by an anchor's component serves all of them, and the
sums over components are unpacked into exact scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loglark.llm.common import Stage, stage, with_package

#: Components are floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative scores from LEAST_PERCENT to 100 percent of its positive.
LEAST_PERCENT = 80
#: Rows of one cell, expected: so many anchors meet so many candidates in a task.
CELL_ANCHORS, CELL_ROWS = 1024, 16_384
#: Whole numbers below 2 ** 53 are exact in the doubles that the matrix product works on.
WIDE_BITS = 53

VECTORS = "row long, id long, label int, vec array<long>"
POSITIVE = "row long, id long, positive long, positive_row long, score long"
NEGATIVE = "row long, anchor_id long, nth int, positive_id long, positive_score long, negative_id long, negative_score long"


def packed_products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``anchors`` with all of ``rows``, whole numbers, exact.

    The width of a field follows from the largest sum that the components at hand allow. Where
    not even one field fits the wide integer, Python's unbounded integers take its place.
    """
    m, n = len(anchors), len(rows)
    if not m or not n or not rows.shape[1]:
        return np.zeros((m, n), dtype=np.int64)
    bias = -min(int(rows.min()), 0)
    top = int(rows.max()) + bias
    # |sum of a * biased component| stays below half of a field.
    most = int(np.abs(anchors).astype(object).sum(1).max())
    half = 1 << max(1, (most * top).bit_length())
    width = half.bit_length()
    fields = max(1, (WIDE_BITS - 1) // width)
    exact = fields * width < WIDE_BITS
    number = np.float64 if exact else object
    groups = -(-n // fields)
    biased = np.zeros((groups * fields, rows.shape[1]), dtype=np.int64)
    biased[:n] = rows + bias
    # Candidate j of a group has the field that begins at bit j * width.
    words = sum(biased[j * groups : (j + 1) * groups].astype(number) * (1 << (j * width)) for j in range(fields))
    sums = anchors.astype(number) @ words.T
    # Half a field is added to each, so that no field borrows from the next.
    sums = sums.astype(np.int64 if exact else object) + sum(half << (j * width) for j in range(fields))
    parts = [(sums >> (j * width)) & ((1 << width) - 1) for j in range(fields)]
    scores = np.concatenate(parts, axis=1)[:, :n] - half
    return scores - bias * anchors.astype(scores.dtype).sum(1)[:, None]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as a matrix of whole numbers; shorter ones are filled with 0, which adds nothing."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class _Side:
    """One side of a cell: rows in the order of their ids, which decides ties."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("id").to_numpy()
        order = np.lexsort((table.column("row").to_numpy(), ids))
        self.table = table.take(pa.array(order))
        self.id = self.table.column("id").to_numpy()
        self.row = self.table.column("row").to_numpy()
        self.label = self.table.column("label").to_numpy()

    def width(self) -> int:
        lengths = self.table.column("vec").combine_chunks().value_lengths()
        return max(lengths.to_pylist(), default=0)

    def matrix(self, width: int) -> np.ndarray:
        return _matrix(self.table.column("vec"), width)


def _scores(left: pa.Table, right: pa.Table) -> tuple[_Side, _Side, np.ndarray]:
    anchors, rows = _Side(left), _Side(right)
    width = max(anchors.width(), rows.width())
    return anchors, rows, packed_products(anchors.matrix(width), rows.matrix(width))


def _highest(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest, ties by place; ``scores`` come in the order of ids."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.argsort(-scores[near], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def _table(columns: list[list], schema: str) -> pa.Table:
    names, types = zip(*[c.split() for c in schema.split(", ")], strict=True)
    kinds = {"long": pa.int64(), "int": pa.int32()}
    return pa.table([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=names)


def _positives(k: int):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in POSITIVE.split(", ")]
        if len(left) and len(right):
            anchors, rows, scores = _scores(left, right)
            for i in range(len(anchors.id)):
                same = np.flatnonzero((rows.label == anchors.label[i]) & (rows.row != anchors.row[i]))
                for j in same[_highest(scores[i, same], k)]:
                    for column, x in zip(out, (anchors.row[i], anchors.id[i], rows.id[j], rows.row[j], scores[i, j]), strict=True):
                        column.append(int(x))
        return _table(out, POSITIVE)

    return find


def _negatives(k: int, least_percent: int):
    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in NEGATIVE.split(", ")]
        if len(left) and len(right):
            anchors, rows, scores = _scores(left, right)
            positives = anchors.table.column("positives").to_pylist()
            for i in range(len(anchors.id)):
                wanted = positives[i] or []
                if not wanted:
                    continue
                own = [int(p["score"]) for p in wanted]
                floor = min(-(-least_percent * s // 100) for s in own)
                near = np.flatnonzero((rows.label != anchors.label[i]) & (scores[i] >= floor) & (scores[i] <= max(own)))
                near = near[np.argsort(-scores[i, near], kind="stable")]
                # Highest first, so those of a positive begin at the first that does not beat it.
                falling = -scores[i, near]
                for p, s in zip(wanted, own, strict=True):
                    begin = int(np.searchsorted(falling, -s, side="left"))
                    for j in near[begin : begin + k]:
                        if 100 * int(scores[i, j]) < least_percent * s:
                            break
                        row = (anchors.row[i], anchors.id[i], p["nth"], p["positive"], s, rows.id[j], scores[i, j])
                        for column, x in zip(out, row, strict=True):
                            column.append(int(x))
        return _table(out, NEGATIVE)

    return find


def usable(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """Rows that take part, as (row, id, label, vec): a written table, so that ``row`` stays the same."""
    vec, number = F.col(vec_col).cast("array<double>"), F.col(id_col).cast("long")
    whole = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.col(label_col).cast("int")
    taken = rows.where(number.isNotNull() & label.isNotNull() & vec.isNotNull() & F.coalesce(whole, F.lit(False)))
    return taken.select(
        F.monotonically_increasing_id().alias("row"),
        number.alias("id"),
        F.when(number % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label).alias("label"),
        F.transform(vec, lambda x: F.floor(x * SCALE)).alias("vec"),
    )


def _cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with (block, slice): every anchor of a block meets every row of a slice once.

    Blocks and slices come from hashes of the row number, so they are of even size whatever the
    ids and labels, and both counts grow with the table while a cell stays as it is.
    """
    blocks, slices = -(-n_anchors // CELL_ANCHORS) or 1, -(-n_rows // CELL_ROWS) or 1

    def by(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = anchors.withColumn("block", by(blocks)).withColumn("slice", every(slices))
    right = rows.withColumn("slice", by(slices)).withColumn("block", every(blocks))
    return left, right


def _in_cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, find, schema: str) -> DataFrame:
    left, right = _cells(anchors, rows, n_anchors, n_rows)
    keys = ["block", "slice"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, schema)


def _first(found: DataFrame, keys: list[str], order: list[Column], k: int, name: str) -> DataFrame:
    """The first k of each group. A group has at most k rows from each slice."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn(name, rank).where(F.col(name) <= k)


def mine(
    rows: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. An anchor's positives are its
    ``positives`` highest-scoring other rows of the same label; for each, its negatives are the
    ``negatives`` highest-scoring rows of another label with at least ``least_percent`` and at
    most 100 percent of the positive's score. Scores are exact inner products of whole numbers,
    ties go to the smaller id. Both searches are over all rows, in cells of bounded size that
    Spark deals out; each cell gives at most its own first rows.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part.
    Of vectors of several lengths the shorter are filled up with 0. A repeated row is a row of
    its own and can be its twin's positive; an anchor that comes twice has its results twice.
    A positive score below 0 has no negatives, as none lies in its range. An empty table gives
    an empty result; other columns are not read. A score must fit 64 bits.
    """
    vectors = Stage(usable(with_package(rows), id_col, vec_col, label_col), "vectors")
    # Each side reads the table for itself: a cogroup of one frame with itself mixes up the columns.
    rows, anchors = (rows.sparkSession.read.schema(vectors.df.schema).parquet(vectors.path) for _ in range(2))
    anchors = anchors.where(F.col("id") % every == 0)
    n_rows, n_anchors = rows.count(), anchors.count()
    best = _in_cells(anchors, rows, n_anchors, n_rows, _positives(positives), POSITIVE)
    order = [F.desc("score"), F.col("positive"), F.col("positive_row")]
    kept = _first(best, ["row"], order, positives, "nth").groupBy("row").agg(
        F.collect_list(F.struct("nth", "positive", "score")).alias("positives")
    )
    known = anchors.join(stage(kept, "positives"), "row")
    found = _in_cells(known, rows, n_anchors, n_rows, _negatives(negatives, least_percent), NEGATIVE)
    order = [F.desc("negative_score"), F.col("negative_id")]
    return _first(found, ["row", "nth"], order, negatives, "rank").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


#: The same for the whole table by plain products of all pairs of an anchor and a row.
SQL = f"""
    with v as (
      select row_number() over () as row, vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
             list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
      from embeddings where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (
      select a.row as row, a.id as anchor_id, b.id as id, b.row as other, a.label = b.label as same,
             list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::bigint as score
      from v a join v b on a.row <> b.row where a.id % 100 = 0),
    p as (
      select row, anchor_id, id as positive_id, score as positive_score,
             row_number() over (partition by row order by score desc, id, other) as nth from s where same),
    n as (
      select p.anchor_id, p.positive_id, row_number() over (partition by p.row, p.nth order by s.score desc, s.id, s.other) as rank,
             s.id as negative_id, p.positive_score, s.score as negative_score
      from p join s on p.row = s.row and not s.same and {LEAST_PERCENT} * p.positive_score <= 100 * s.score
        and s.score <= p.positive_score where p.nth <= {POSITIVES})
    select * from n where rank <= {NEGATIVES}"""
