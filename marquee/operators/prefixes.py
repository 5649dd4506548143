"""Running sums and maxima over long histories of few scopes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.rounds import kept

#: Bounds of the ranges that one table is cut into.
MOST_RANGES = 1 << 14


def bounds(df: DataFrame, place: str, rows_per_range: int) -> list[int]:
    """Places (whole numbers) at which a new range begins: quantiles of all rows, a range for every ``rows_per_range`` of them, 16,384 at most.

    One job counts and takes 1023 quantiles; only a table that asks for more ranges is read again. A place is never parted, so
    a place of very many rows is one range.
    """
    few = 1 << 10
    probs = lambda n: F.array(*[F.lit(i / n) for i in range(1, n)])
    quantiles = lambda n: F.percentile_approx(place, probs(n), F.lit(16 * n))
    total, found = df.agg(F.count("*"), quantiles(few)).first()
    wanted = min(MOST_RANGES, max(1, -(-total // rows_per_range)))
    if wanted > few:
        found = df.agg(quantiles(wanted)).first()[0]
    elif found:
        found = [found[i * few // wanted - 1] for i in range(1, wanted)]
    return sorted(set(found or []))


def range_of(place: Column, cuts: Sequence[int]) -> Column:
    """How many of the ascending ``cuts`` are at most ``place``: a binary search in a constant array. Null for a null place."""
    steps = [1 << b for b in range(len(cuts).bit_length() - 1, -1, -1)] if cuts else []
    if not steps:
        return F.when(place.isNotNull(), F.lit(0))
    most = (1 << 63) - 1
    table = F.array(*[F.lit(c).cast("long") for c in [*cuts, *[most] * (2 * steps[0] - 1 - len(cuts))]])
    at = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda low, s: F.when((low + s <= len(cuts)) & (F.element_at(table, low + s) <= place), low + s).otherwise(low))
    return F.when(place.isNotNull(), at)


def joined(kind: str, a: Column, b: Column) -> Column:
    """A value carried over and one of the own range, either of which may be null."""
    return F.greatest(a, b) if kind == "max" else F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def with_carried(cut: DataFrame, carried: DataFrame, scope: str) -> DataFrame:
    """Rows with what their scope carries into their range; null scopes and ranges meet their own."""
    carried = carried.withColumnRenamed(scope, "_scope").withColumnRenamed("_range", "_of")
    return cut.join(carried, F.col(scope).eqNullSafe(F.col("_scope")) & F.col("_range").eqNullSafe(F.col("_of")), "left").drop("_scope", "_of")


def running(df: DataFrame, scope: str, place: str, order: list, values: dict[str, tuple[str, Column]], rows_per_range: int = 500_000, before: bool = False) -> DataFrame:
    """Adds running values (name: ("sum" or "max", column)) along ``order`` within ``scope``; ``before`` leaves the row itself out.

    ``place`` is the whole number that ``order`` begins with. Ranges of it come from quantiles over all rows (``bounds``), so they hold about
    as many rows each, whatever outliers there are, and grow in number with the table. One value per scope and range is carried over the
    ranges before, and windows run inside ranges only. A sum without rows before is null.
    """
    kinds = {"sum": F.sum, "max": F.max}
    cut = df.withColumn("_range", range_of(F.col(place), bounds(df, place, rows_per_range)))
    cut = cut.withColumns({f"_v_{n}": v for n, (_, v) in values.items()})
    totals = cut.groupBy(scope, "_range").agg(*[kinds[k](f"_v_{n}").alias(f"_t_{n}") for n, (k, _) in values.items()])
    # A row for each scope and range.
    earlier = Window.partitionBy(scope).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(scope, "_range", *[kinds[k](f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (k, _) in values.items()])
    inside = Window.partitionBy(scope, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    out = with_carried(cut, carried, scope)
    out = out.withColumns({n: joined(k, F.col(f"_c_{n}"), kinds[k](f"_v_{n}").over(inside)) for n, (k, _) in values.items()})
    return reduce(lambda d, c: d.drop(c), [c for n in values for c in (f"_v_{n}", f"_c_{n}")] + ["_range"], out)


def key_bounds(df: DataFrame, key: Column, rows_per_range: int, each: int = 64) -> list:
    """Sort keys (structs) at which a new range begins: every ``each``-th of a sample that holds about that many keys a range; none for a table of one range.

    Rows are chosen by a hash of their key; the driver gets ``each`` keys for each of 1024 ranges at most.
    """
    total = df.count()
    wanted = min(1 << 10, -(-total // rows_per_range))
    if wanted < 2:
        return []
    share = max(1, total // (each * wanted))
    keys = df.select(key.alias("k")).where(F.pmod(F.xxhash64("k"), F.lit(share)) == 0).distinct().orderBy("k")
    found = [r.k for r in keys.limit(4 * each * wanted).collect()]
    step = max(1, len(found) // wanted)
    return found[step::step]


def ordinals(df: DataFrame, group: str, order: list[Column], name: str = "place", rows_per_range: int = 500_000) -> DataFrame:
    """Adds each row's place (from 1) within ``group`` in ascending ``order`` (nulls first), as row_number() does, but over ranges of the order.

    A group of very many rows is cut where ``key_bounds`` says; rows are numbered inside each range, and the number of rows of the
    ranges before is carried over. Rows of one key are never parted.
    """
    df = df.withColumn("_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    cuts = key_bounds(df, F.col("_key"), rows_per_range)
    if not cuts:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy("_key"))).drop("_key")
    kind = df.schema["_key"].dataType
    table = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(c, kind, strict=True)]) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1)])
    at = F.aggregate(steps, F.lit(0), lambda low, s: F.when((low + s <= len(cuts)) & (F.try_element_at(table, low + s) <= F.col("_key")), low + s).otherwise(low))
    cut = df.withColumn("_range", at)
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut.groupBy(group, "_range").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).select(group, "_range", "_before")
    own = F.row_number().over(Window.partitionBy(group, "_range").orderBy("_key"))
    return with_carried(cut, carried, group).withColumn(name, (F.col("_before") + own).cast("int")).drop("_key", "_range", "_before")


def placed(df: DataFrame, order: list[Column], folder: str, rows: int, name: str = "place", rows_per_range: int = 500_000) -> DataFrame:
    """Adds each row's place (from 1) among all ``rows`` in ascending ``order`` (nulls first): one group's ``ordinals``, whose table is made once.

    Rows are dealt by ranges of the order and written as each range is sorted, with their number inside it. How many rows the ranges
    before hold is counted from what was written. Read back, rows come in runs of consecutive places.
    """
    sorted_ranges = df.repartitionByRange(max(1, -(-rows // rows_per_range)), *order).sortWithinPartitions(*order)
    out, _ = kept(sorted_ranges.withColumn("_at", F.monotonically_increasing_id()), folder, name)
    # The id's upper bits are the range, its lower 33 the row's number in it.
    at = F.shiftright("_at", 33).cast("int")
    held = {r.at: r.n for r in out.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect()}
    before = F.array(*[F.lit(n).cast("long") for n in accumulate((held.get(i, 0) for i in range(max(held, default=0))), initial=0)])
    return out.withColumn(name, (F.element_at(before, at + 1) + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).cast("int")).drop("_at")
