"""Pieces that several operators share: the shared folder, text buffers, words, components."""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.skew import crowded_keys, join_crowded

#: White space between words: space and U+0009 to U+000D.
SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.default_rng(20240607)
#: One odd random 64-bit value per byte.
BYTE_VALUES = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        folder = f"file:///tmp/checkpoints/{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str, packed: bool = False) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it again, which cuts its lineage.

    Tables whose rows hold some megabytes each are ``packed``: smaller row groups, which a reader holds whole.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    options = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 4, "compression": "zstd"} if packed else {}
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.table_path = path
    return out


def discard(spark: SparkSession, *tables: str | DataFrame) -> None:
    """Deletes tables (paths, or what ``materialize`` returned) that no plan reads any more."""
    for table in tables:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table if isinstance(table, str) else table.table_path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def with_row_key(docs: DataFrame, key: str = "row_key") -> DataFrame:
    """Adds a long that no other row has: its doc_id, but for rows of null doc_id and all but one of a doc_id's rows, whose keys
    lie beyond all doc_ids. Where ids repeat or are null, rows are numbered once and written to the shared folder with their number,
    so every job that reads the result sees the same keys, however the cluster plans its scans."""
    count = docs.agg(F.count("*"), F.countDistinct("doc_id"), F.max("doc_id")).first()
    if count[0] == count[1]:
        return docs.withColumn(key, F.col("doc_id").cast("long"))
    docs = materialize(docs.withColumn("_uid", F.monotonically_increasing_id()), "keyed")
    first = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min("_uid").alias("_uid")).select("_uid", F.lit(True).alias("_first"))
    own = F.when(F.col("_first"), F.col("doc_id")).otherwise(F.col("_uid") + F.lit((count[2] or 0) + 1)).cast("long")
    return docs.join(first, "_uid", "left").withColumn(key, own).drop("_uid", "_first")


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Total UTF-8 length of a text column; 0 for an empty table."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def most_frequent(counts: DataFrame, most: int, name: str) -> DataFrame:
    """Rows of ``counts`` (with a column n) above a frequency that at most ``most`` rows reach.

    The frequency comes from a histogram of a few hundred steps, so no task or driver ever holds or sorts more than
    ``most`` rows; steps are narrow, and the one that would exceed ``most`` is left out whole.
    """
    counts = materialize(counts, name)
    step = F.floor(F.log2("n") * 8).cast("int")
    total, low = 0, 1 << 30
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect():
        total += r.rows
        if total > most:
            break
        low = r.step
    return counts.where(step >= low)


def partitions(groups: int) -> int:
    """Partitions for so many groups: one each, up to what a driver can still schedule; beyond that a task takes its groups one after another."""
    return min(groups, 20_000)


def with_group(df: DataFrame, key: str, groups: int) -> DataFrame:
    return df.withColumn("g", F.expr(f"cast(pmod(xxhash64({key}), {groups}) as int)"))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column end to end, and where each text begins (one more offset than texts). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def bytes_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The reverse of ``text_buffer``, as binary values."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SEPARATORS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in the bytes, and the number of words before each text (one more than texts)."""
    inside = ~separators[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def powers(n: int) -> np.ndarray:
    out = np.full(n, MULTIPLIER, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUES, chunk: int = 1 << 16) -> np.ndarray:
    """A 64-bit hash of each (non-empty) byte span."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(0, len(starts), chunk):
        s, e = starts[i : i + chunk], ends[i : i + chunk]
        lengths = e - s
        before = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
        x = values[data[within + np.repeat(s, lengths)]] * powers(int(lengths.max()))[within]
        out[i : i + chunk] = mix(np.add.reduceat(x, before) + lengths.astype(np.uint64))
    return out


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def trim_memory() -> None:
    """Gives memory that this process (the driver, or a worker that now waits for its next task) has freed back to the system, where the C library can."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release:
        release(0)


def connected_components(edges: DataFrame, name: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (src, dst): the smallest node it reaches.

    Alternating large-star and small-star rounds; every round is written to the shared folder, so nothing
    is held by the driver or by one executor, and the round before it is deleted. Nodes of very many links are dealt
    over several tasks. Rounds grow with the logarithm of the longest chain; 60 stand for more nodes than a long can name.
    """
    spark = edges.sparkSession
    path, before = None, None

    def settle(frame: DataFrame) -> DataFrame:
        nonlocal path
        old, path = path, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        frame.write.parquet(path)
        if old:
            discard(spark, old)
        return spark.read.schema(frame.schema).parquet(path)

    same = settle(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    for _ in range(most_rounds):
        both = same.select("u", "v").unionByName(same.select(F.col("v").alias("u"), F.col("u").alias("v")))
        degrees = both.groupBy("u").agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
        now = degrees.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)), F.sum("h")).first()
        if now == before:
            break
        before = now
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_crowded(both, low, "u", "v", crowded_keys(both, "u", *now[:2])).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(down.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b")
        same = settle(small.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    else:
        raise RuntimeError("components did not settle")
    roots = same.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return same.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
