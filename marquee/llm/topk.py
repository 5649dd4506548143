"""Exact maximum inner product search over integer vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm import vectors as V

#: Steps of a factor of two in the lengths that say which bands a block of queries still needs.
STEPS = 16


def search_block(queries: np.ndarray, qids: np.ndarray, floors: np.ndarray, candidates: np.ndarray, cids: np.ndarray, rotation: np.ndarray, k: int, lead: int = 16, step: int = 512) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score): the k best candidates of each query, ties to the smaller id, that reach the query's floor.

    Candidates come by descending length. Scores are summed over the ``lead`` directions of largest
    variance; the rest is at most the product of both residual lengths (Cauchy-Schwarz), which is added as
    one more dimension. Only candidates whose bound reaches the floor (the k-th best score so far) are scored, exactly,
    on the integers; once even the full length can't reach it for any query, the scan ends.
    """
    order = np.lexsort((cids, -np.einsum("ij,ij->i", candidates, candidates)))
    candidates, cids = candidates[order], cids[order]
    lead = min(lead, rotation.shape[1])

    def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x @ rotation
        return np.column_stack((y[:, :lead], np.sqrt(np.maximum(0, np.einsum("ij,ij->i", x, x) - np.einsum("ij,ij->i", y[:, :lead], y[:, :lead]))))), np.linalg.norm(x, axis=1)

    q, q_norm = split(queries.astype(np.float64))
    c, c_norm = split(candidates.astype(np.float64))
    best = np.full((len(queries), k), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    slack = 1e-9
    for at in range(0, len(candidates), step):
        floor = np.maximum(best[:, -1], floors)
        if np.all(q_norm * c_norm[at] * (1 + slack) < floor):
            break
        bound = q @ c[at : at + step].T
        i, j = np.nonzero(bound + slack * (np.outer(q_norm, c_norm[at : at + step]) + 1) >= floor[:, None])
        j += at
        other = qids[i] != cids[j]
        i, j = i[other], j[other]
        score = np.empty(len(i), np.int64)
        for p in range(0, len(i), 1 << 18):
            score[p : p + (1 << 18)] = np.einsum("ij,ij->i", queries[i[p : p + (1 << 18)]], candidates[j[p : p + (1 << 18)]])
        keep = score >= floor[i]
        i, j, score = i[keep], j[keep], score[keep]
        found.append((i, j, score))
        # The k best so far of the queries that gained candidates.
        touched, row = np.unique(i, return_inverse=True)
        if len(touched):
            rank = np.lexsort((-score, row))
            head = np.searchsorted(row[rank], np.arange(len(touched)))
            place = np.arange(len(rank)) - head[row[rank]]
            top = place < k
            fresh = np.full((len(touched), k), -np.inf)
            fresh[row[rank][top], place[top]] = score[rank][top]
            best[touched] = -np.sort(-np.concatenate((best[touched], fresh), axis=1), axis=1)[:, :k]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    i, j, score = (np.concatenate(x) for x in zip(*found, strict=True))
    rank = np.lexsort((cids[j], -score, i))
    i, j, score = i[rank], j[rank], score[rank]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    keep = place < k
    return i[keep], order[j[keep]], score[keep]


def length_bands(good: DataFrame, bands: int) -> DataFrame:
    """(band, n, ids, x, high): all vectors by descending length, a row for each of about ``bands`` bands, ``high`` being its greatest length."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(np.asarray(b.column(0)), V.matrix(b.column(1))) for b in batches if b.num_rows]
        if parts:
            ids, x = np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts])
            high = float(np.sqrt(np.einsum("ij,ij->i", x, x).max()))
            row = [TaskContext.get().partitionId(), len(ids), ids.astype(np.int64).tobytes(), x.tobytes(), high]
            yield pa.RecordBatch.from_pylist([dict(zip(("band", "n", "ids", "x", "high"), row, strict=True))], schema=pa.schema([("band", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("x", pa.binary()), ("high", pa.float64())]))

    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    ranged = good.withColumn("square", square).repartitionByRange(bands, F.desc("square"), F.xxhash64("vec_id"), "vec_id")
    return ranged.select("vec_id", "x").mapInArrow(gather, "band int, n int, ids binary, x binary, high double")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, query_bytes: int = 512 << 10, band_bytes: int = 32 << 20, band_rows: int | None = None, parts: int = 4) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each vector whose id is divisible by ``every`` its ``k``
    highest integer inner products among all other vectors, of components ``floor(scale * x)``; ties go to the
    smaller id; all candidates if there are fewer than ``k``.

    Candidates lie in bands of descending length (16 times the root of their number to a band, ``band_bytes`` in double precision at most,
    which is 65,536 vectors of 64 dimensions, unless ``band_rows`` says otherwise); queries come in blocks of ``query_bytes``. Every block of queries meets the band of greatest length first, which gives each query a
    floor: its k-th best score there, and then splits into ``parts`` of like floors. A band that is too short to reach any
    floor of a part (Cauchy-Schwarz) never meets it; the
    other bands do, each pair of band and part as one row of work. Queries travel to bands, so candidates are shuffled once.
    No pair list is made: a band gives at most ``k`` rows per query, and a query's rows from all bands are ranked together.

    Vectors that are null or hold null or non-finite components, or have another length than most, take no
    part; a repeated id stands for its smallest array; null ids take no part. Zero vectors score 0.
    """
    good = V.usable(vectors, "vec_id", "embedding")
    good = C.materialize(good.select("vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("double")).alias("x")), "integer-vectors")
    spark = vectors.sparkSession
    n = good.count()
    out_schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], out_schema)
    x = V.sample(good)
    size = 8 * max(1, x.shape[1])
    band_rows = band_rows or max(1, min(band_bytes // size, max(1024, int(16 * n**0.5))))
    blocks = -(-n // (every * max(1, query_bytes // size)))
    rotation = np.linalg.svd(x, full_matrices=True)[2].T if len(x) else np.zeros((0, 0))
    bands = C.materialize(length_bands(good, -(-n // band_rows)), "bands", packed=True)
    # One small row for each step of the lengths: the last band that reaches it.
    step = F.floor(F.log2(F.greatest("high", F.lit(1.0))) * STEPS).cast("int")
    last = sorted(tuple(r) for r in bands.groupBy(step.alias("step")).agg(F.max("band"), F.min("band")).collect())
    first = min(low for *_, low in last)
    packed = V.pack(good.where(F.col("vec_id") % every == 0).withColumn("block", F.expr(f"cast(pmod(xxhash64(vec_id, 7), {blocks}) as int)")), "block")
    # One band of at most ``band_bytes`` (its rows are chosen so) is sent to every block, as a hash join: its key isn't folded into a literal.
    meet = packed.withColumn("band", F.col("block") * 0 + first).join(F.broadcast(bands.where(F.col("band") == first).select("band", F.col("ids").alias("cids"), F.col("x").alias("c"))), "band")

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in V.rows(batches):
            cids, c = V.unpack(r["cids"], r["c"])
            qids, q = V.unpack(r["ids"], r["x"])
            i, _, score = search_block(q.astype(np.int64), qids, np.full(len(qids), -np.inf), c.astype(np.int64), cids, rotation, k)
            floors = np.full(len(qids), -np.inf)
            full = np.flatnonzero(np.bincount(i, minlength=len(qids)) == k)
            floors[full] = score[np.searchsorted(i, full, side="right") - 1]
            length = np.linalg.norm(q, axis=1)
            # A band whose greatest length is less reaches no floor of this block; the product is rounded down a little.
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(floors > 0, floors / length * (1 - 1e-9), 0.0)
            # Queries of like need go on together, so one that needs every band takes only its own part along.
            for part in np.array_split(np.argsort(need, kind="stable"), min(parts, len(qids))):
                row = [[r["block"]], [qids[part].tobytes()], [q[part].tobytes()], [floors[part].tobytes()], [need[part].min()]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, [pa.int32(), *[pa.binary()] * 3, pa.float64()], strict=True)], ["block", "qids", "q", "floors", "need"])

    begun = C.materialize(meet.select("block", "ids", "x", "cids", "c").mapInArrow(begin, "block int, qids binary, q binary, floors binary, need double"), "query-blocks", packed=True)
    needed = F.floor(F.log2(F.greatest("need", F.lit(1.0))) * STEPS).cast("int")
    steps = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(top).alias("top")) for s, top, _ in last])
    reach = F.array_max(F.transform(steps, lambda s: F.when(s.step >= needed, s.top).otherwise(first)))
    many = bands.count()
    work = begun.withColumn("band", F.explode(F.sequence(F.lit(first), reach))).repartition(many, "band")
    pairs = work.join(bands.select("band", "ids", "x", "high").repartition(many, "band"), "band").where("high >= need")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in V.rows(batches):
            cids, c = V.unpack(r["ids"], r["x"])
            qids, q = V.unpack(r["qids"], r["q"])
            i, j, score = search_block(q.astype(np.int64), qids, np.frombuffer(r["floors"], np.float64), c.astype(np.int64), cids, rotation, k)
            yield pa.RecordBatch.from_arrays([pa.array(qids[i]), pa.array(cids[j]), pa.array(score)], ["query_id", "vec_id", "score"])

    found = pairs.select("ids", "x", "qids", "q", "floors").mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
