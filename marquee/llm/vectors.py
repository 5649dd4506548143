"""Vectors in packed tiles, and rotations fitted on a bounded sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 4096


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, x): one row per id, with a vector that is not null and holds only finite components (floats stay floats).

    An id that repeats stands for its smallest array; vectors of another length than the commonest take no part.
    """
    x = F.col(column)
    if vectors.schema[column].dataType.simpleString() not in ("array<float>", "array<double>"):
        x = x.cast("array<double>")
    good = vectors.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull())
    good = good.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    sizes = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    good = good.where(F.size("x") == (sizes.d if sizes else 0))
    ids = good.agg(F.count("*"), F.countDistinct("vec_id")).first()
    return good if ids[0] == ids[1] else good.groupBy("vec_id").agg(F.min("x").alias("x"))


def sample(good: DataFrame) -> np.ndarray:
    """At most SAMPLE vectors, those of smallest id hash; only for fitting a rotation, which affects speed alone."""
    rows = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    return np.array([r.x for r in rows], np.float64)


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def pack(frame: DataFrame, key: str) -> DataFrame:
    """(key, n, ids, x): the rows of each key as little-endian blocks, in the order of their ids."""

    def gather(k: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        return pa.table({key: pa.array([k[0].as_py()], pa.int32()), "n": pa.array([table.num_rows], pa.int32()), "ids": pa.array([table["vec_id"].to_numpy().astype(np.int64).tobytes()], pa.binary()), "x": pa.array([matrix(table["x"]).tobytes()], pa.binary())})

    return frame.select(key, "vec_id", "x").groupBy(key).applyInArrow(gather, f"{key} int, n int, ids binary, x binary")


def unpack(ids: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(x, np.float64).reshape(len(i), -1)


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
