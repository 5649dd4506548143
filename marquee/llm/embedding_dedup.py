"""Near-duplicate vectors by cosine, tile against tile in the order of the principal components."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.skew import crowded_keys, join_crowded
from marquee.llm import common as C
from marquee.llm import vectors as V

#: Components that order the vectors, bits of each in that order, and components that bound a tile.
ORDERED, BITS, BOXED = 5, 6, 8


def settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joins the classes of ``label`` (each node points at a smaller or equal one) along the links (i, j)."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            deeper = label[label]
            if np.array_equal(deeper, label):
                break
            label = deeper


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; none is zero."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def suffix_norms(y: np.ndarray, m: int) -> np.ndarray:
    """Lengths of what rotated unit rows hold beyond their first ``m`` components."""
    return np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", y[:, :m], y[:, :m])))


class Tile:
    """Unit rows with their leading components, each prefix followed by its suffix norm, and the bounds of the tile."""

    def __init__(self, u: np.ndarray, rotation: np.ndarray, leads: tuple[int, ...] = (16, 40)):
        self.u, y = u, u @ rotation
        self.prefixes = [np.column_stack((y[:, :m], suffix_norms(y, m))) for m in leads if m < y.shape[1]] or [y]
        self.coarse = self.prefixes[0].astype(np.float32)
        box = np.column_stack((y[:, :BOXED], suffix_norms(y, BOXED)))
        self.low, self.high = box.min(axis=0), box.max(axis=0)


def apart(a_low: np.ndarray, a_high: np.ndarray, b_low: np.ndarray, b_high: np.ndarray) -> float:
    """Least squared distance of two boxes."""
    gap = np.maximum(0, np.maximum(a_low - b_high, b_low - a_high))
    return float((gap * gap).sum())


def link_tiles(a: Tile, b: Tile | None, least: float, weight_a: np.ndarray, weight_b: np.ndarray, step: int = 512, part: int = 1 << 18) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the rows of two tiles (b None: within one): weights of the partners of each row of a, of b, and classes.

    Leading components are multiplied first, and the product of the suffix norms, which bounds what the other
    components can add, is one more dimension of the same product; a pair goes on only while its bound reaches
    ``least``. Pairs that pass every prefix are decided in full.
    """
    within = b is None
    b = a if within else b
    n = len(a.u)
    label = np.arange(n + (0 if within else len(b.u)))
    count_a, count_b = np.zeros(n), np.zeros(len(b.u))
    for at in range(0, n, step):
        begin = at if within else 0
        every = np.nonzero(a.coarse[at : at + step] @ b.coarse[begin:].T >= np.float32(least - 1e-4))
        for k in range(0, len(every[0]), part):
            i, j = every[0][k : k + part] + at, every[1][k : k + part] + begin
            if within:
                i, j = i[j > i], j[j > i]
            for ya, yb in zip(a.prefixes[1:], b.prefixes[1:], strict=True):
                good = np.einsum("ij,ij->i", ya[i], yb[j]) >= least - 1e-9
                i, j = i[good], j[good]
            good = np.einsum("ij,ij->i", a.u[i], b.u[j]) >= least
            i, j = i[good], j[good]
            if len(i):
                count_a += np.bincount(i, weights=weight_b[j], minlength=n)
                count_b += np.bincount(j, weights=weight_a[i], minlength=len(b.u))
                label = settle(label, i, j if within else j + n)
    return (count_a + count_b, count_b[:0], label) if within else (count_a, count_b, label)


def link_vectors(vectors: DataFrame, least: float = 0.95, tile_bytes: int = 1 << 20, stripe_bytes: int = 64 << 20, stripes: int = 3) -> DataFrame:
    """One row per vector: vec_id, n_links (others with cosine ``least`` or more), component_id, kept.

    Cosine is computed in double precision. Equal vectors are one class, compared once and counted with their number.
    Classes are ordered along a curve through their first principal components and cut into tiles of ``tile_bytes`` in double
    precision (2048 vectors of 64 dimensions, one at least); a tile keeps the bounds of its leading components and suffix norms. Tiles
    form ``stripes``, more of them where one would pass ``stripe_bytes``: what a task holds doesn't grow with the dimension. A pair of stripes is a task if their bounds come within reach of each other, and so is a pair
    of tiles inside it. So a vector travels once for each stripe within reach: over all, the root of the
    number of tasks. A task returns weights and a spanning forest of its links, never the links. Spark joins the components.
    Null, zero and unusable vectors are listed without links; a repeated id is one vector; null ids are left
    out. The worst case is quadratic in the number of different vectors; labels and other columns are not read.
    """
    every = vectors.select(F.col("vec_id").cast("long")).where("vec_id is not null").distinct()
    good = V.usable(vectors, "vec_id", "embedding").where(F.exists("x", lambda v: v != 0))
    x = V.sample(good)
    if not len(x):
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    tile_rows = max(1, tile_bytes // (8 * x.shape[1]))
    stripe_rows = max(tile_rows, stripe_bytes // (8 * x.shape[1]))
    x = unit_rows(x)
    rotation = np.linalg.svd(x - x.mean(axis=0), full_matrices=True)[2].T
    cuts = [np.quantile(x @ rotation[:, c], np.arange(1, 1 << BITS) / (1 << BITS)) for c in range(min(ORDERED, x.shape[1]))]
    kind = np.dtype("<f4" if good.schema["x"].dataType.simpleString() == "array<float>" else "<f8")

    def curve(u: np.ndarray) -> np.ndarray:
        """The place of each row on a curve that takes one bit of each component in turn."""
        place, bins = np.zeros(len(u), np.int64), [np.searchsorted(cut, u @ rotation[:, c]) for c, cut in enumerate(cuts)]
        for bit in range(BITS - 1, -1, -1):
            for b in bins:
                place = place << 1 | (b >> bit & 1)
        return place

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies within a batch keep one array, that of the smallest id.
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(np.asarray(batch.column(0)), kind="stable")
                ids, v = np.asarray(batch.column(0))[order], V.matrix(batch.column(1))[order]
                raw = [r.tobytes() for r in (v + 0.0).astype(kind)]
                names = [blake2b(r, digest_size=16).digest() for r in raw]
                seen: dict[bytes, int] = {}
                leader = np.array([seen.setdefault(name, i) for i, name in enumerate(names)])
                copies = np.bincount(leader, minlength=len(leader))
                mask = leader != np.arange(len(leader))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(names, pa.binary()), pa.array(curve(unit_rows(v))), pa.array(copies), pa.array([None if m else r for r, m in zip(raw, mask, strict=True)], pa.binary())], ["vec_id", "name", "place", "copies", "v"])

    placed = C.materialize(good.select("vec_id", "x").mapInArrow(place, "vec_id long, name binary, place long, copies long, v binary"), "placed")
    classes = placed.groupBy("name").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    classes = C.materialize(classes, "vector-classes")
    n = classes.count()
    wanted = max(stripes, -(-n // stripe_rows))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), None
        held: list[tuple[int, int, bytes]] = []

        def tile() -> pa.RecordBatch:
            raw = b"".join(v for *_, v in held)
            u = Tile(unit_rows(np.frombuffer(raw, kind).reshape(len(held), -1)), rotation)
            ids, copies = (np.array([r[c] for r in held], np.int64).tobytes() for c in (0, 1))
            types = [pa.int64(), *[pa.binary()] * 3, *[pa.list_(pa.float64())] * 2]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, ids, copies, raw, u.low.tolist(), u.high.tolist()), types, strict=True)], ["part", "ids", "copies", "v", "low", "high"])

        for batch in batches:
            for i, name, n, v in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if name == before:
                    held[-1] = (held[-1][0], held[-1][1] + n, held[-1][2])
                else:
                    if len(held) == tile_rows:
                        yield tile()
                        held.clear()
                    before = name
                    held.append((i, n, v))
        if held:
            yield tile()

    ranged = placed.where("v is not null").repartitionByRange(wanted, "place", "name").sortWithinPartitions("place", "name", "vec_id")
    tiles = tiles_table = C.materialize(ranged.select("vec_id", "name", "copies", "v").mapInArrow(cut, "part long, ids binary, copies binary, v binary, low array<double>, high array<double>"), "tiles", packed=True)
    parts = (tiles.agg(F.max("part")).first()[0] or 0) + 1
    tiles = tiles.withColumn("stripe", F.floor(F.col("part") * min(wanted, parts) / parts).cast("int"))
    span = range(min(BOXED, x.shape[1]) + 1)
    boxes = tiles.groupBy("stripe").agg(F.array(*[F.min(F.col("low")[c]) for c in span]).alias("low"), F.array(*[F.max(F.col("high")[c]) for c in span]).alias("high"))
    gaps = lambda p, q: F.zip_with(p, q, lambda a, b: F.greatest(a - b, F.lit(0.0)))
    distance = F.aggregate(F.zip_with(gaps("low", "high2"), gaps("low2", "high"), lambda a, b: F.pow(F.greatest(a, b), 2)), F.lit(0.0), lambda s, v: s + v)
    reach = 2 - 2 * least + 1e-9
    both = boxes.withColumn("other", F.explode(F.sequence("stripe", F.lit(min(wanted, parts) - 1))))
    both = both.join(boxes.select(F.col("stripe").alias("other"), F.col("low").alias("low2"), F.col("high").alias("high2")), "other")
    units = C.materialize(both.where(distance <= reach).select("stripe", "other"), "units")
    left = tiles.join(units, "stripe").select("stripe", "other", F.lit(0).alias("side"), "ids", "v", "copies")
    right = tiles.withColumnRenamed("stripe", "other").join(units, "other").where("stripe < other").select("stripe", "other", F.lit(1).alias("side"), "ids", "v", "copies")

    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        side, found = table["side"].to_numpy(), ([], [])
        names = [np.frombuffer(r, np.int64) for r in table["ids"].to_pylist()]
        size = np.array([len(i) for i in names])
        begin, ids = np.cumsum(size) - size, np.concatenate(names)
        weight = np.concatenate([np.frombuffer(r, np.int64) for r in table["copies"].to_pylist()]).astype(np.float64)
        for s, r, m in zip(side, table["v"].to_pylist(), size, strict=True):
            found[s].append(Tile(unit_rows(np.frombuffer(r, kind).reshape(int(m), -1)), rotation))
        at = [begin[side == 0], begin[side == 1]]
        count, label = np.zeros(len(ids)), np.arange(len(ids))
        within = key[0].as_py() == key[1].as_py()
        for i, a in enumerate(found[0]):
            for j, b in enumerate(found[0] if within else found[1]):
                if (within and j < i) or apart(a.low, a.high, b.low, b.high) > reach:
                    continue
                same = within and i == j
                p, q = at[0][i], at[0 if within else 1][j]
                own, theirs, joined = link_tiles(a, None if same else b, least, weight[p : p + len(a.u)], weight[q : q + len(b.u)])
                count[p : p + len(a.u)] += own
                if not same:
                    count[q : q + len(b.u)] += theirs
                row = np.arange(p, p + len(a.u)) if same else np.concatenate((np.arange(p, p + len(a.u)), np.arange(q, q + len(b.u))))
                moved = np.flatnonzero(joined != np.arange(len(joined)))
                if len(moved):
                    label = settle(label, row[moved], row[joined[moved]])
        some = np.flatnonzero((count > 0) | (label != np.arange(len(label))))
        return pa.table({"vec_id": ids[some], "root": ids[label[some]], "n": count[some].astype(np.int64)})

    work = left.unionByName(right)
    found = C.materialize(work.groupBy("stripe", "other").applyInArrow(link, "vec_id long, root long, n long"), "links")
    component = C.connected_components(found.select(F.col("vec_id").alias("src"), F.col("root").alias("dst")), "vector-components")
    C.discard(vectors.sparkSession, tiles_table, units)
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    roots = classes.join(counts, "vec_id", "left").join(component.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    roots = roots.select("name", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    members = placed.select("name", "vec_id")
    members = join_crowded(members, roots, "name", "vec_id", crowded_keys(members, "name")).drop("name")
    out = every.join(members, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("component_id") == F.col("vec_id"))


def op4(spark, sf_dir: str) -> DataFrame:
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
