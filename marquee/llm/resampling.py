"""Importance resampling of documents towards the word distribution of a target table."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.bpe import slices

#: Bytes that part words, after A-Z are lower-cased: ASCII without digits and letters.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
FULL = np.uint32(0xFFFFFFFF)
#: Longer words are hashed by the library one by one.
LONG = 64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


CRC = _crc_table()


def _shift_tables(bits: int = 31) -> np.ndarray:
    """Tables [b, k, v]: what byte v at place k of a checksum becomes when 2**b zero bytes follow."""
    one = np.arange(256, dtype=np.uint32)
    table = np.stack([one << np.uint32(8 * k) for k in range(4)])
    table = CRC[table & np.uint32(0xFF)] ^ (table >> np.uint32(8))
    out = [table]
    for _ in range(bits - 1):
        out.append(_shift(out[-1], out[-1]))
    return np.stack(out)


def _shift(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][values & np.uint32(0xFF)] ^ table[1][(values >> np.uint32(8)) & np.uint32(0xFF)] ^ table[2][(values >> np.uint32(16)) & np.uint32(0xFF)] ^ table[3][values >> np.uint32(24)]


SHIFTS = _shift_tables()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of each (non-empty) byte span; all short spans step together."""
    lengths = ends - starts
    out = np.full(len(starts), FULL, np.uint32)
    order = np.argsort(-np.minimum(lengths, LONG + 1), kind="stable")
    first = int(np.count_nonzero(lengths > LONG))
    state, at, size = out[order[first:]], starts[order[first:]], lengths[order[first:]]
    negative = -size
    for i in range(int(size.max(initial=0))):
        n = int(np.searchsorted(negative, -i))  # spans longer than i bytes
        state[:n] = CRC[(state[:n] ^ data[at[:n] + i]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    out[order[first:]] = state ^ FULL
    for k in order[:first].tolist():
        out[k] = zlib.crc32(data[starts[k] : ends[k]])
    return out


def joined_checksums(left: np.ndarray, right: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The crc32 of "a b" from those of a and b, and the length of b."""
    x = left ^ FULL
    x = CRC[(x ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (x >> np.uint32(8)) ^ FULL
    for b in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero(lengths >> b & 1)
        x[at] = _shift(x[at], SHIFTS[b])
    return x ^ right


def features(column, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, text by text; where each text's begin; the words of each text. Features are words and pairs of neighbours."""
    data, offsets = C.text_buffer(column)
    data = C.lower_ascii(data)
    starts, ends, bounds = C.find_words(data, offsets, BREAKS)
    one = checksums(data, starts, ends)
    words = np.diff(bounds)
    paired = np.ones(len(one), bool)  # words after which another one of the text comes
    paired[bounds[1:][words > 0] - 1] = False
    left = np.flatnonzero(paired)
    two = joined_checksums(one[left], one[left + 1], (ends - starts)[left + 1])
    number = words + np.maximum(words - 1, 0)
    begin = np.concatenate(([0], np.cumsum(number)))
    out = np.empty(begin[-1], np.int64)
    owner = np.repeat(np.arange(len(words)), words)
    place = begin[owner] + np.arange(len(one)) - bounds[owner]
    out[place] = one % np.uint32(buckets)
    out[place[left] + words[owner[left]]] = two % np.uint32(buckets)
    return out, begin, words


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all whole texts each bucket holds: one array a task, summed by Spark; the driver gets ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                total += np.bincount(features(part.column(0), buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    found = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of how much likelier each bucket is in the target, one added to each count, rounded down."""
    n = len(source)
    rows, scale = zip(source.tolist(), target.tolist(), strict=True), (float(source.sum()) + n, float(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * scale[0] / ((s + 1.0) * scale[1]))) for s, t in rows], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """The document's draw: a thousandth-fold Gumbel number from its id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, target: DataFrame, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every whole text."""
    table = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs, buckets), bucket_counts(target, buckets)))
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                bucket, begin, words = features(part.column(1), buckets)
                total = np.diff(np.concatenate(([0], np.cumsum(table.value[bucket])))[begin])
                number = np.diff(begin)
                weight = total // np.maximum(number, 1)
                score = weight + np.array([gumbel(i, seed) for i in part.column(0).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words), pa.array(number), pa.array(weight), pa.array(score)], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def smallest_reaching(rows: DataFrame, value, wanted: int, halvings: int = 4) -> tuple[int, int]:
    """The smallest x such that at least ``wanted`` (1 or more, at most all) rows have ``value`` <= x, and how many have less than x.

    Bisection by exact counts: each job counts below every middle that the next ``halvings`` steps can come to.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    before = 0  # rows under low
    while low < high:
        step = -(-(high - low + 1) // (1 << halvings))
        marks = [*range(low + step - 1, high, step)]
        counts = rows.agg(*(F.count(F.when(value <= F.lit(m), 1)) for m in marks)).first()
        reached = next((i for i, n in enumerate(counts) if n >= wanted), len(marks))
        if reached:
            low, before = marks[reached - 1] + 1, counts[reached - 1]
        if reached < len(marks):
            high = marks[reached]
    return low, before


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """Every document with its score, and the rank of those drawn: doc_id, n_words, n_features, weight, score, rank.

    Of the N documents with ``least_words`` words, floor(percent * N / 100) of the highest scores are drawn, ties to
    the smaller doc_id (null ids last; rows of one id and one score in the order they were written). Scores are written to the
    shared folder once; exact counts over them bisect the score of the last one drawn, and its doc_id where that
    score is tied. Drawn rows are dealt by ranges, so no task sorts more than its range; ranks are places in a range
    and the sizes of the ranges before. Null texts have no words; without any features a weight is 0.
    """
    spark = docs.sparkSession
    table = scores(docs, target, buckets, seed).withColumn("uid", F.monotonically_increasing_id())
    table = C.materialize(table.withColumn("at", F.coalesce("doc_id", F.lit((1 << 63) - 1))), "scores")
    fit = table.where(F.col("n_words") >= least_words)
    wanted = fit.count() * percent // 100
    columns = ("doc_id", "n_words", "n_features", "weight", "score")
    if not wanted:
        return table.select(*columns, F.lit(None).cast("long").alias("rank"))
    chosen, rest = F.lit(False), F.lit(True)
    for value in (-F.col("score"), F.col("at"), F.col("uid")):
        x, before = smallest_reaching(fit.where(rest), value, wanted)
        chosen, rest, wanted = chosen | (rest & (value < x)), rest & (value == x), wanted - before
        if fit.where(rest).count() == wanted:
            chosen = chosen | rest
            break
    chosen = chosen & (F.col("n_words") >= least_words)
    order = (F.desc("score"), F.asc("at"), F.asc("uid"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    drawn = table.where(chosen).repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    drawn = C.materialize(drawn, "drawn")
    split = F.shiftright("place", 33).alias("range")
    sizes, offsets, total = dict(drawn.groupBy(split).count().collect()), [], 0
    for r in sorted(sizes):
        offsets.append((r, total))
        total += sizes[r]
    offsets = F.broadcast(spark.createDataFrame(offsets, "range int, before long"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    drawn = drawn.withColumn("range", split.cast("int")).join(offsets, "range").select(*columns, rank.alias("rank"))
    return drawn.unionByName(table.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13(spark, sf_dir: str) -> DataFrame:
    out = resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
