"""Running sums and exact quantiles that no single task has to hold.

A window without a partition key sends every row to one task. Here rows are first dealt into buckets along the
order column, by approximate quantiles that only set the speed; each bucket is summed by itself, and the sums of
the buckets before it, a table of groups times buckets, are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The least and most buckets, and the values that a bucket is made for between them.
BUCKETS, BUCKETS_MOST, VALUES = 32, 512, 100_000


def rank_sql(column: str, cuts: list[float], test: str = ">") -> str:
    """SQL: how many of the sorted cuts hold `column test cut`, as a binary search of comparisons that compile to plain code."""

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"CASE WHEN {column} {test} CAST('{cuts[mid]!r}' AS DOUBLE) THEN {search(mid + 1, high)} ELSE {search(low, mid)} END"

    return search(0, len(cuts))


def _bucket(df: DataFrame, order: str, buckets: int | None) -> Column:
    shares = [k / BUCKETS_MOST for k in range(1, BUCKETS_MOST)]
    got = df.agg(F.percentile_approx(order, F.array(*map(F.lit, shares)), F.lit(4 * BUCKETS_MOST)).alias("q"), F.count(order).alias("n")).first() if buckets != 1 else None
    if got is None or not got.q:
        return F.lit(0)
    many = buckets or max(BUCKETS, min(BUCKETS_MOST, got.n // VALUES))
    cuts = sorted({got.q[len(got.q) * k // many] for k in range(1, many)})
    if not cuts:
        return F.lit(0)
    return F.expr(f"CASE WHEN `{order}` IS NOT NULL THEN {rank_sql(f'`{order}`', [float(c) for c in cuts])} END")


def running(
    df: DataFrame, by: list[str], order: list[Column], sums: dict[str, str], descending: bool = False, buckets: int | None = None,
    totals: dict[str, str] | None = None, source: DataFrame | None = None,
) -> DataFrame:
    """df with, for each name: column of sums, the sum over the rows before in the order (exclusive), by group, and for each of totals
    the sum over all rows of the group.

    The first order item must be a column name; rows alike in the whole order may come in any order. The buckets are learned
    from `source`, which must have that column too: rows before they were counted are cheaper to read than counts.
    """
    first, totals = order[0], totals or {}
    learned = df if source is None else source
    # null and NaN order values have no bucket of their own; they sort as Spark sorts them
    df = df.withColumn("_b", F.coalesce(_bucket(learned.where(F.col(first).isNotNull()), first, buckets), F.lit(-1)))
    way = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    inner = Window.partitionBy(*by, "_b").orderBy(*way).rowsBetween(Window.unboundedPreceding, -1)
    step = F.col("_b").desc() if descending else F.col("_b").asc()
    outer = Window.partitionBy(*by, *([] if by else [F.lit(0)])).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by, *([] if by else [F.lit(0)]))
    heads = df.groupBy(*by, "_b").agg(*(F.sum(c).alias(f"_s_{n}") for n, c in sums.items()), *(F.sum(c).alias(f"_t_{n}") for n, c in totals.items()))
    heads = heads.select(
        *(F.col(b).alias(f"_k_{i}") for i, b in enumerate(by)), F.col("_b").alias("_kb"),
        *(F.coalesce(F.sum(f"_s_{n}").over(outer), F.lit(0)).alias(f"_o_{n}") for n in sums),
        *(F.sum(f"_t_{n}").over(whole).alias(n) for n in totals),
    )
    inside = df.withColumns({f"_i_{n}": F.coalesce(F.sum(c).over(inner), F.lit(0)) for n, c in sums.items()})
    on = [F.col(b).eqNullSafe(F.col(f"_k_{i}")) for i, b in enumerate(by)] + [F.col("_b") == F.col("_kb")]
    out = inside.join(heads, on)
    return out.select(*(c for c in df.columns if c != "_b"), *((F.col(f"_i_{n}") + F.col(f"_o_{n}")).alias(n) for n in sums), *totals)


def quantiles(df: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """by, share, quantile: exact quantiles with linear interpolation, as numpy and pandas give them; nulls do not count.

    Values are counted first, so a group costs its distinct values. Groups are features, bases or the like: the wanted ranks, as many
    as groups and shares, are sent to every task.
    """
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*by, value).agg(F.count("*").alias("n"))
    placed = running(counts, by, [value], {"before": "n"}, source=known)
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("size"))
    wanted = sizes.select(
        *by, "size",
        F.explode(F.array(*(F.lit(float(p)) for p in shares))).alias("share"),
    ).withColumn("at", (F.col("size") - 1) * F.col("share"))
    wanted = wanted.withColumns({"low": F.floor("at"), "high": F.ceil("at")})
    left = placed.alias("p")
    right = wanted.alias("w")
    on = [F.col(f"p.{b}").eqNullSafe(F.col(f"w.{b}")) for b in by]
    inside = lambda c: (F.col("p.before") <= F.col(f"w.{c}")) & (F.col(f"w.{c}") < F.col("p.before") + F.col("p.n"))
    hit = left.join(F.broadcast(right), [*on, inside("low") | inside("high")]) if by else left.join(F.broadcast(right), inside("low") | inside("high"))
    got = hit.groupBy(*(F.col(f"w.{b}").alias(b) for b in by), F.col("w.share").alias("share")).agg(
        F.max(F.when(inside("low"), F.col(f"p.{value}"))).cast("double").alias("a"),
        F.max(F.when(inside("high"), F.col(f"p.{value}"))).cast("double").alias("b"),
        F.max(F.col("w.at") - F.col("w.low")).alias("f"),
    )
    return got.select(*by, "share", (F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias("quantile"))
