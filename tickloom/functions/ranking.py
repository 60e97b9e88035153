"""Order statistics and latest-row picks that keep every group distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialise


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """First row per key in the given order.

    A row number compared with a constant lets Spark cut each partition to one row per key before
    the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def keep_recent(
    df: DataFrame, keys: Sequence[str], keep: int, *order: Column | str
) -> DataFrame:
    """The ``keep`` first rows per key in the given order."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= keep)
    ).drop("_place")


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, *, limit: int = 50_000, pivots: int = 64
) -> DataFrame:
    """Continuous median of the non-NULL values per key, without gathering a group in one task.

    Equal values are counted first (map-side), so a heavily repeated value costs one row. A group
    with more than ``limit`` different values is searched in rounds: approximate quantiles of the
    values still in question are its pivots, exact counts between the pivots tell which cell holds
    the middle ranks, and the search goes on in that cell. Pivots come from the data, so each round
    leaves about one in ``pivots`` values, however they lie; the exact counts make up for what the
    quantiles miss. At the end at most ``limit`` values are put in order.

    NaN counts as greater than all other values, as in Spark's own ``median``, and the mean of a
    number and NaN is NaN. Groups with NULL keys are groups of their own; groups without a value
    give no row.
    """
    keys = list(keys)
    counted = materialise(
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_x"))
        .agg(F.count(F.lit(1)).alias("_c")),
        "median_values",
    )
    middle = (F.sum("_c") - 1) / 2
    searches = counted.groupBy(*keys).agg(
        F.floor(middle).alias("_low"), F.ceil(middle).alias("_high"),
        F.lit(0).cast("long").alias("_below"),
        F.min("_x").alias("_from"), F.max("_x").alias("_to"), F.count(F.lit(1)).alias("_distinct"),
    )
    searches = materialise(searches, "median_searches")
    while (searches.agg(F.max("_distinct")).first()[0] or 0) > limit:
        searches = materialise(_narrowed(counted, searches, keys, limit, pivots), "median_searches")

    inside = _inside(counted, searches, keys)
    before = Window.partitionBy(*keys, "_from").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    placed = inside.withColumn("_before", F.col("_below") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
    end = F.col("_before") + F.col("_c")

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_before") <= F.col(rank)) & (F.col(rank) < end), F.col("_x")))

    return placed.groupBy(*keys).agg((at("_low") * 0.5 + at("_high") * 0.5).alias("median"))


def _inside(counted: DataFrame, searches: DataFrame, keys: list[str]) -> DataFrame:
    """The counted values that each search still covers."""
    match = F.col("v._x").between(F.col("s._from"), F.col("s._to"))
    for key in keys:
        match = match & F.col(f"s.{key}").eqNullSafe(F.col(f"v.{key}"))
    return counted.alias("v").join(searches.alias("s"), match).select("s.*", "v._x", "v._c")


def _narrowed(
    counted: DataFrame, searches: DataFrame, keys: list[str], limit: int, pivots: int
) -> DataFrame:
    """One round: large searches go on in the cells that hold their ranks."""
    large = F.col("_distinct") > limit
    inside = _inside(counted, searches.where(large), keys)
    by = [*keys, "_from"]
    # NaN is no number to take quantiles of; it lies beyond the last pivot
    numbers = inside.where(~F.isnan("_x")).groupBy(*by)
    shares = F.array(*[F.lit(i / pivots) for i in range(1, pivots)])
    edges = numbers.agg(F.percentile_approx("_x", shares, F.lit(100 * pivots)).alias("_edges"))
    match = F.col("e._from").eqNullSafe(F.col("i._from"))
    for key in keys:
        match = match & F.col(f"e.{key}").eqNullSafe(F.col(f"i.{key}"))
    celled = inside.alias("i").join(edges.alias("e"), match).select("i.*", "e._edges")
    cell = F.size(F.filter("_edges", lambda edge: edge < F.col("_x")))
    cells = celled.groupBy(*by, cell.alias("_cell")).agg(
        F.sum("_c").alias("_inside"), F.count(F.lit(1)).alias("_n"),
        F.min("_x").alias("_least"), F.max("_x").alias("_most"),
        *[F.first(c).alias(c) for c in ("_low", "_high", "_below")],
    )
    # a search has at most as many cells as pivots
    before = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_inside").over(before), F.lit(0)))

    def held(rank: str) -> Column:
        here = (F.col("_below") <= F.col(rank)) & (F.col(rank) < F.col("_below") + F.col("_inside"))
        return F.when(here, F.col(rank)).alias(rank)

    found = placed.select(
        *keys, held("_low"), held("_high"), "_below", F.col("_least").alias("_from"),
        F.col("_most").alias("_to"), F.col("_n").alias("_distinct"),
    ).where("_low is not null or _high is not null")
    return searches.where(~large).unionByName(found)
