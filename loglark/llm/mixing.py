"""Mixing sources to target weights by hierarchical budgets, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglark.llm.common import WORD, Stage, fresh, stage

#: Bits of the seeded order, and those that make its buckets.
ORDER_BITS, BUCKET_BITS = 60, 12
SEED = 7
MAX_EPOCHS = 2

#: The tree of the documents table and the target weights of its nodes; others weigh 1.
DOMAIN = "case when right(source, 1) in ('0', '1', '2', '3', '4') then 'web' else 'books' end"
LEVELS = {"domain": DOMAIN, "lang": "lang", "source": "source"}
WEIGHTS = {"domain": {"web": 3, "books": 2}, "lang": {"en": 4, "de": 2, "fr": 2}}


def count_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(level: str, name: Column, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1)
    for value, weight in weights.get(level, {}).items():
        out = F.when(name == value, weight).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Budgets of siblings from their parent's ``budget``, by weight, none above its capacity.

    What a node cannot use goes to its siblings by weight. Nodes are taken by capacity per
    weight: while the next one's capacity is below its share of what is left, it is filled.
    """
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    nodes = nodes.withColumn("capacity", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0))
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ordered = siblings.orderBy(F.col("capacity") / F.when(F.col("weight") > 0, F.col("weight")), name)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        nodes.withColumns(
            {
                "left": F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0)),
                "onward": F.sum("weight").over(onward),
            }
        )
        .withColumn("full", (F.col("weight") > 0) & (wide("capacity") * wide("onward") <= wide("weight") * wide("left")))
        .withColumns(
            {
                "used": F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(siblings),
                "open": F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(siblings),
            }
        )
        .withColumn(
            "budget",
            F.when(F.col("full"), F.col("capacity")).otherwise(
                F.expr(
                    "coalesce(cast((budget - used) as decimal(18,0)) * cast(weight as decimal(18,0))"
                    " div nullif(cast(open as decimal(18,0)), 0), 0)"
                )
            ),
        )
        .drop("left", "onward", "full", "used", "open", "weight")
    )


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], share: float, max_epochs: int
) -> DataFrame:
    """Token budget of each leaf; ``leaves`` has the level columns and ``tokens``.

    The root gets ``share`` of all tokens. Going down, each node's budget is shared among
    its children, so a shortage is made up among siblings first, and only what a whole
    subtree lacks goes to the siblings of its root.
    """
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    budgets = leaves.agg(
        F.least(F.floor(F.sum("tokens") * F.lit(share)), F.sum("capacity")).cast("long").alias("budget")
    )
    for depth, name in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        if depth:
            nodes = nodes.join(budgets.select(*path[:-1], "budget"), path[:-1])
        else:
            nodes = nodes.withColumn("budget", budgets.scalar())
        budgets = _share(nodes.withColumn("weight", _weight(name, F.col(name), weights)), path[:-1], name)
    return leaves.drop("capacity").join(budgets.select(*levels, "budget"), list(levels))


def _order(key: Column, epoch: Column, seed: int) -> Column:
    """Place of a document in its leaf's queue of one epoch."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key))
    return F.conv(F.substring(digest, 1, ORDER_BITS // 4), 16, 10).cast("long")


def _cuts(rows: DataFrame, leaves: DataFrame, levels: list[str], seed: int) -> DataFrame:
    """For each leaf the place up to which its last epoch is taken.

    The queue is summed in 4096 buckets of places, then only the bucket in which the budget
    ends is summed by place. No leaf's rows are ever put in order as a whole.
    """
    placed = rows.join(leaves.select(*levels, "epochs", "rest"), levels).withColumn(
        "place", _order(F.col("key"), F.col("epochs"), seed)
    )
    bucket = F.shiftright("place", ORDER_BITS - BUCKET_BITS)
    sums = placed.groupBy(*levels, bucket.alias("bucket")).agg(
        F.sum("tokens").alias("tokens"), F.first("rest").alias("rest")
    )
    upto = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (
        sums.withColumn("upto", F.sum("tokens").over(upto))
        .where(F.col("upto") > F.col("rest"))
        .groupBy(*levels)
        .agg(F.min(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left"))).alias("end"))
        .select(*levels, "end.*")
    )
    ends = stage(ends, "mix-ends")
    last = (
        placed.withColumn("at", bucket)
        .join(ends, levels)
        .where(F.col("at") == F.col("bucket"))
        .groupBy(*levels, "place")
        .agg(F.sum("tokens").alias("tokens"), F.first("left").alias("left"))
    )
    upto = Window.partitionBy(*levels).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (
        last.withColumn("upto", F.sum("tokens").over(upto))
        .where(F.col("upto") <= F.col("left"))
        .groupBy(*levels)
        .agg(F.max("place").alias("cut"))
    )
    before = F.shiftleft(F.col("bucket").cast("long"), ORDER_BITS - BUCKET_BITS) - 1
    return (
        leaves.select(*levels, "epochs", "budget", "rest")
        .join(ends, levels, "left")
        .join(inside, levels, "left")
        .select(
            *levels,
            "epochs",
            F.when(F.col("rest") == 0, F.lit(-1)).otherwise(F.coalesce("cut", before, F.lit(1 << ORDER_BITS))).alias("cut"),
        )
    )


def mix(
    docs: DataFrame,
    levels: Mapping[str, str] = LEVELS,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS,
    share: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` chosen for the mixture, each with its ``mix_epoch``, ``mix_tokens``
    and the nodes of its leaf as ``mix_<level>``.

    ``levels`` names the levels of the tree, top first, with their SQL expressions;
    ``weights`` holds whole weights of nodes. A leaf whose budget is k times its tokens and a
    rest gives k whole epochs and, from the next one's seeded order, the longest prefix of
    documents with at most the rest. A leaf gives ``max_epochs`` epochs at most.

    Nulls in a level are the node ``''``; null ids share a place; null texts have no tokens.
    Rows with the same id are chosen together. A leaf without tokens gives no rows, an empty
    table an empty result. Columns named like new ones get the new value.
    """
    names = [f"mix_{k}" for k in levels]
    by_name = {f"mix_{k}": v for k, v in weights.items()}
    columns = {f"mix_{k}": F.coalesce(F.expr(v).cast("string"), F.lit("")) for k, v in levels.items()}
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = Stage(
        docs.select(*[c.alias(n) for n, c in columns.items()], key.alias("key"), count_tokens(F.col(text_col)).alias("tokens")),
        "mix-rows",
    )
    leaves = stage(rows.df.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    leaves = stage(
        leaf_budgets(leaves, names, by_name, share, max_epochs)
        .withColumn("epochs", F.expr("coalesce(budget div nullif(tokens, 0), 0)").cast("int"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")),
        "mix-budgets",
    )
    plan = stage(_cuts(rows.df, leaves, names, seed), "mix-plan")
    rows.drop()
    kept = [c for c in docs.columns if c.lower() not in {*names, "mix_epoch", "mix_tokens"}]
    ours, epochs, cut, place = fresh(docs, "_key", "_epochs", "_cut", "_place")
    plan = plan.withColumnsRenamed({"epochs": epochs, "cut": cut})
    return (
        docs.select(
            *[F.col(f"`{c}`") for c in kept],
            *[c.alias(n) for n, c in columns.items()],
            count_tokens(F.col(text_col)).alias("mix_tokens"),
            key.alias(ours),
        )
        .join(plan, names)
        .withColumn(place, _order(F.col(ours), F.col(epochs), seed))
        .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col(epochs))))
        .where((F.col("mix_epoch") < F.col(epochs)) | (F.col(place) <= F.col(cut)))
        .drop(ours, epochs, cut, place)
    )


def _sql() -> str:
    """The same for DuckDB, over the documents table with the parameters above."""

    def case(level: str) -> str:
        cases = "".join(f" when {level} = '{v}' then {w}" for v, w in WEIGHTS.get(level, {}).items())
        return f"case{cases} else 1 end" if cases else "1"

    names = list(LEVELS)
    parts = [
        "with docs as (select doc_id, "
        + ", ".join(f"coalesce(cast({v} as varchar), '') as {k}" for k, v in LEVELS.items())
        + f", cast(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as bigint) as tokens from documents)",
        f"leaves as (select {', '.join(names)}, cast(sum(tokens) as bigint) as tokens from docs group by all)",
        "b0 as (select cast(sum(tokens) as bigint) as budget from leaves)",
    ]
    for depth, name in enumerate(names):
        path, up = names[: depth + 1], names[:depth]
        on = f"join b{depth} using ({', '.join(up)})" if up else f"cross join b{depth}"
        part = f"partition by {', '.join(up)}" if up else ""
        order = f"{part} order by capacity / cast(weight as double), {name}"
        cols = ", ".join(path)
        parts += [
            f"n{depth} as (select {cols}, capacity, budget, {case(name)} as weight from (select {cols}, sum(tokens) * {MAX_EPOCHS} as capacity from leaves group by all) {on})",
            f"o{depth} as (select *, budget - coalesce(sum(capacity) over ({order} rows between unbounded preceding and 1 preceding), 0) as remaining, sum(weight) over ({order} rows between current row and unbounded following) as onward from n{depth})",
            f"f{depth} as (select *, cast(capacity as hugeint) * cast(onward as hugeint) <= cast(weight as hugeint) * cast(remaining as hugeint) as filled from o{depth})",
            f"b{depth + 1} as (select {cols}, case when filled then cast(capacity as hugeint) else coalesce(cast(budget - used as hugeint) * weight // nullif(unfilled, 0), 0) end as budget from (select *, sum(case when filled then capacity else 0 end) over ({part}) as used, cast(sum(case when filled then 0 else weight end) over ({part}) as hugeint) as unfilled from f{depth}))",
        ]
    using = ", ".join(names)
    parts += [
        f"plan as (select {using}, cast(coalesce(budget // nullif(tokens, 0), 0) as int) as epochs, budget - coalesce(budget // nullif(tokens, 0), 0) * tokens as rest from leaves join b{len(names)} using ({using}))",
        f"placed as (select *, cast('0x' || substr(md5(concat_ws(':', '{SEED}', cast(epochs as varchar), cast(doc_id as varchar))), 1, {ORDER_BITS // 4}) as bigint) as place from docs join plan using ({using}))",
        f"upto as (select *, sum(tokens) over (partition by {using} order by place) as upto from placed)",
        f"cuts as (select {using}, min(place) as cut from upto where upto > rest group by all)",
    ]
    return (
        ", ".join(parts)
        + f" select doc_id, cast(e.e as int) as mix_epoch, tokens as mix_tokens, {', '.join(f'{n} as mix_{n}' for n in names)}"
        + f" from placed left join cuts using ({using}) cross join (select unnest(range(0, {MAX_EPOCHS} + 1)) as e) e"
        + " where e.e < epochs or (e.e = epochs and rest > 0 and (cut is null or place < cut))"
    )


SQL = _sql()
