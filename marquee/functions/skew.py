"""Joins of large tables, and of tables whose keys may be crowded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_A_TASK = 300_000


def join_dealt(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of two tables of any size, both dealt by their keys and sorted.

    Spark guesses sizes from compressed files, a guess that explode() and long strings leave behind; by it, it would send the seemingly smaller table whole through the driver.
    """
    return left.join(right.hint("merge"), on, how)


def join_streamed(many: DataFrame, one: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``many`` joined with ``one``, a narrow row for each key: only a task's share of ``one`` is held, rows of ``many`` pass by unsorted and so are never spilled."""
    return many.join(one.hint("shuffle_hash"), on, how)


def join_counted(many: DataFrame, one: DataFrame, rows: int, on: str | list[str], how: str = "inner") -> DataFrame:
    """``many`` joined with ``one`` of ``rows`` rows, counted and not guessed: as many as one task takes are broadcast, so that ``many`` stays where it is; more are dealt as in ``join_streamed``."""
    return many.join(one.hint("broadcast" if rows <= ROWS_A_TASK else "shuffle_hash"), on, how)


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over tasks of some ``ROWS_A_TASK`` of its ``rows``, at least one for each core.

    Left to itself, Spark deals by compressed bytes, and like rows compress so well that one task then holds millions of them.
    """
    return df.repartition(max(-(-rows // ROWS_A_TASK), df.sparkSession.sparkContext.defaultParallelism), *keys)


def crowded_keys(many: DataFrame, key: str, total: int | None = None, top: int | None = None) -> DataFrame | None:
    """(key, _parts) of the keys that hold over a 2000th of all rows, so 2000 at most; None if no key does. ``top`` is the rows of the largest key."""
    counts = many.groupBy(key).agg(F.count("*").alias("n"))
    if total is None:
        total, top = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    least = max(total // 2000, 100)
    return counts.where(F.col("n") > least).select(key, F.ceil(F.col("n") / least).cast("int").alias("_parts")) if top > least else None


def join_crowded(many: DataFrame, one: DataFrame, key: str, spread: str, crowded: DataFrame | None, how: str = "inner", dealt: bool = False) -> DataFrame:
    """``many`` joined on ``key`` with ``one`` (a row for each key), ``crowded`` keys dealt over several tasks.

    Rows of a crowded key are dealt by a hash of ``spread``, and its row of ``one`` goes to each of those tasks. At
    most 2000 keys are broadcast, whatever the size. ``how`` is inner or left (which keeps all of ``many``). With ``dealt``
    neither table is broadcast, see ``join_dealt``.
    """
    meet = join_dealt if dealt else DataFrame.join
    if crowded is None:
        return meet(many, one, key, how)
    crowded = F.broadcast(crowded)
    many = many.join(crowded, key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_parts").cast("long")).cast("int"), F.lit(0))).drop("_parts")
    one = one.join(crowded, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return meet(many, one, [key, "_part"], how).drop("_part")
