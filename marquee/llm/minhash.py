"""Near-duplicate documents: HyperMinHash registers in bands, estimates, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.skew import crowded_keys, join_crowded
from marquee.llm import common as C
from marquee.llm.bpe import slices
from marquee.llm.embedding_dedup import settle

MANTISSA = 10
#: Expected share of equal registers of unlike sets, by the analysis of the sketch (0.1699 / 2^r).
CHANCE = 0.1699 / 2**MANTISSA


@dataclass(frozen=True)
class Sketch:
    shingle: int  # words
    least: int  # similarity in hundredths
    registers: int = 252

    @property
    def rows(self) -> int:
        """Registers of a band: the most that miss a pair at the threshold less than once in 100,000."""
        t = self.least / 100
        good = [r for r in range(1, self.registers) if (1 - t**r) ** (self.registers // r) <= 1e-5]
        return max(good, default=1)

    @property
    def smallest(self) -> int:
        """Sets with fewer shingles link only with equal ones."""
        return -(-self.least // (100 - self.least)) if self.least < 100 else 1 << 62

    def sets(self, column) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text."""
        data, offsets = C.text_buffer(column)
        data = C.lower_ascii(data)
        starts, ends, bounds = C.find_words(data, offsets)
        word = C.hash_spans(data, starts, ends)
        k, n = self.shingle, len(word)
        h = np.full(max(n - k + 1, 0), k, np.uint64)
        for i in range(k):
            h = C.mix(h * C.MULTIPLIER + word[i : n - k + 1 + i])
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(h[a : b - k + 1]))
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for x in word[a:b]:
                    whole = C.mix(whole * C.MULTIPLIER + x)
                out.append(whole)
            else:
                out.append(h[:0])
        return out

    def sketch(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of registers for each set: leading zeros + 1, then MANTISSA bits, of the least hash in a bucket; 0: empty."""
        m, sizes = self.registers, [len(s) for s in sets]
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        slot = np.repeat(np.arange(len(sets)), sizes) * m + (every % np.uint64(m)).astype(np.int64)
        low = np.full(len(sets) * m, 2**64 - 1, np.uint64)
        np.minimum.at(low, slot, C.mix(every ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(1))
        empty = low == 2**64 - 1
        zeros = np.minimum(63 - np.frexp(np.where(empty, 1, low).astype(np.float64))[1], 61).astype(np.uint64)
        bits = (low << (zeros + np.uint64(2))) >> np.uint64(64 - MANTISSA)
        out = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | bits
        return np.where(empty, 0, out).astype(np.uint16).reshape(len(sets), m)

    def dense(self, registers: np.ndarray) -> np.ndarray:
        """Registers whose empty ones are filled from the first full one in an order of their own, so that registers of two
        sets agree about as often as the sets do even when sets are small."""
        m, out = self.registers, registers.copy()
        order = np.random.default_rng(3).permuted(np.tile(np.arange(m), (m, 1)), axis=1)
        row, column = np.nonzero((registers == 0) & registers.any(axis=1)[:, None])
        for t in range(m):
            if not len(row):
                break
            value = registers[row, order[column, t]]
            full = value > 0
            out[row[full], column[full]] = value[full]
            row, column = row[~full], column[~full]
        return out

    def bands(self, registers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and key of every band that is not empty."""
        r, b = self.rows, self.registers // self.rows
        x = self.dense(registers)[:, : r * b].reshape(-1, b, r).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, b + 1, dtype=np.uint64), x.shape[:2]).copy()
        for i in range(r):
            key = C.mix(key * C.MULTIPLIER + x[:, :, i])
        row, band = np.nonzero(x.any(axis=2))
        return row, key[row, band].view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity corrected for chance collisions, and its 6-sigma margin, from rows of registers."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    j = (same / np.maximum(used, 1) - CHANCE) / (1 - CHANCE)
    return j, 3 / np.sqrt(np.maximum(used, 1))


PACKED = ("docs", "components", "counts", "hashes")


def _packed(members: DataFrame) -> DataFrame:
    """One row per group and tile: ids, components, set sizes and all hashes of its members, end to end."""

    def gather(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        raw = table["hashes"].to_pylist()
        row = {"grp": key[0].as_py(), "tile": key[1].as_py(), "docs": table["doc"].to_numpy().astype(np.int64).tobytes(), "components": table["component"].to_numpy().astype(np.int64).tobytes(), "counts": np.array([len(x) // 8 for x in raw], np.int64).tobytes(), "hashes": b"".join(raw)}
        return pa.Table.from_pylist([row], schema=pa.schema([("grp", pa.int64()), ("tile", pa.int32()), *((c, pa.binary()) for c in PACKED)]))

    columns = ", ".join(f"{c} binary" for c in PACKED)
    return members.select("grp", "tile", "doc", "component", "hashes").groupBy("grp", "tile").applyInArrow(gather, f"grp long, tile int, {columns}")


def intersections(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray, block: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all sets of two tiles. Hashes that many hold are multiplied as matrices, the others are counted pair by pair."""
    out = np.zeros((len(na), len(nb)), np.float32)
    row_a, row_b = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
    order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    ua, fa, ca = np.unique(a[order_a], return_index=True, return_counts=True)
    ub, fb, cb = np.unique(b[order_b], return_index=True, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    fa, ca, fb, cb = fa[ia], ca[ia], fb[ib], cb[ib]
    row_a, row_b = row_a[order_a], row_b[order_b]
    heavy = np.flatnonzero(ca * cb >= 256)
    for at in range(0, len(heavy), block):
        part = heavy[at : at + block]
        sides = []
        for rows, first, count, n in ((row_a, fa[part], ca[part], len(na)), (row_b, fb[part], cb[part], len(nb))):
            x = np.zeros((n, len(part)), np.float32)
            take = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - first, count)
            x[rows[take], np.repeat(np.arange(len(part)), count)] = 1
            sides.append(x)
        out += sides[0] @ sides[1].T
    light = np.flatnonzero(ca * cb < 256)
    for at in range(0, len(light), 1 << 16):
        part = light[at : at + (1 << 16)]
        x, y, both = ca[part], cb[part], ca[part] * cb[part]
        k = np.arange(int(both.sum())) - np.repeat(np.cumsum(both) - both, both)
        wide = np.repeat(y, both)
        pair = row_a[np.repeat(fa[part], both) + k // wide] * len(nb) + row_b[np.repeat(fb[part], both) + k % wide]
        out += np.bincount(pair, minlength=out.size).reshape(out.shape).astype(np.float32)
    return out


def tile_links(left: dict, right: dict, least: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (document, root) of the links between members of different components of two tiles."""
    (da, ka, na), (db, kb, nb) = (tuple(np.frombuffer(t[c], np.int64) for c in PACKED[:3]) for t in (left, right))
    both = intersections(np.frombuffer(left["hashes"], np.uint64), na, np.frombuffer(right["hashes"], np.uint64), nb)
    i, j = np.nonzero((100 * both >= least * (na[:, None] + nb[None, :] - both)) & (ka[:, None] != kb[None, :]))
    label = settle(np.arange(len(da) + len(db)), i, j + len(da)) if len(i) else np.arange(len(da) + len(db))
    names = np.concatenate((da, db))
    moved = np.flatnonzero(label != np.arange(len(label)))
    return names[moved], names[label[moved]]


def near_duplicates(docs: DataFrame, shingle: int = 5, least: int = 80, tile: int = 512, tile_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked where 100 * intersection >= ``least`` * union.

    Sets hold the distinct ``shingle``-word runs of the whole text, A-Z lowered; a shorter text is one run; no
    words: an empty set, which links with nothing. Equal sets are one class from the start. Candidates share a
    band of HyperMinHash registers; those whose corrected estimate is not clearly too low are verified on the
    full sets. In a bucket every member is compared with the smallest. Buckets that share members form groups; where
    a group holds several components, its members outside the largest one meet all its members in tiles of
    about ``tile`` documents, fewer where their sets would pass ``tile_bytes``, which return the links between components as a forest. So no list of a group's pairs
    is made, members that are already joined are not compared again, and no link between components is lost. Work
    on such a group grows with the number of its members times that of those outside its largest component.
    component_id is the smallest doc_id reachable, kept marks that document.

    Pivots of very many members, like all nodes of very many links, are dealt over several tasks.
    Null texts count as empty; rows of null doc_id are left out; rows that repeat a doc_id are one document,
    the one of smallest fingerprint. Sets are compared by 64-bit hashes of their runs.
    """
    kind = Sketch(shingle, least)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = kind.sets(part.column(1))
                registers = kind.sketch(sets)
                names = [blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.array([r.tobytes() for r in registers], pa.binary())], ["doc_id", "n", "name", "registers"])
        C.trim_memory()

    signed = docs.mapInArrow(sign, "doc_id long, n long, name binary, registers binary")
    ids = docs.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if ids[0] != ids[1]:
        signed = signed.groupBy("doc_id").agg(F.min(F.struct("name", "n", "registers")).alias("s")).select("doc_id", "s.n", "s.name", "s.registers")
    signed = C.materialize(signed, "signed")
    classes = signed.where("n > 0").groupBy("name").agg(F.min(F.struct("doc_id", "n", "registers")).alias("s"))
    classes = C.materialize(classes.select("name", "s.doc_id", "s.n", "s.registers"), "classes")

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                registers = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(part.num_rows, -1)
                row, key = kind.bands(registers)
                yield pa.RecordBatch.from_arrays([pa.array(key), part.column(0).take(pa.array(row))], ["key", "doc"])

    banded = classes.where(F.col("n") >= kind.smallest).select("doc_id", "registers").mapInArrow(band, "key long, doc long")
    buckets = banded.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("other")).where("pivot <> other").select("key", "pivot")
    members = C.materialize(banded.join(buckets, "key"), "members")

    registers = classes.select(F.col("doc_id").alias("doc"), "n", "registers")
    hundred = least

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
            j, margin = estimate(a, b)
            yield batch.select(["a", "b"]).filter(pa.array(j >= hundred / 100 - margin))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((s, t))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= hundred * (len(s) + len(t) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    def attach(pairs: DataFrame, values: DataFrame, column: str) -> DataFrame:
        # A pivot may have a third of all pairs.
        left = join_crowded(pairs, values.select(F.col("doc").alias("a"), F.col(column).alias("va")), "a", "b", pivots)
        return left.join(values.select(F.col("doc").alias("b"), F.col(column).alias("vb")), "b").select("a", "b", "va", "vb")

    def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = kind.sets(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc", "name", "hashes"])

    # Sets only of documents that share a band with another.
    need = members.select("doc").distinct().join(classes.select(F.col("doc_id").alias("doc"), "name"), "doc")
    sets = docs.join(need.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(shingle_sets, "doc long, name binary, hashes binary")
    sets = sets.join(need, ["doc", "name"], "left_semi").select("doc", "hashes")
    sets = C.materialize(sets if ids[0] == ids[1] else sets.dropDuplicates(["doc"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        size = registers.select("doc", "n")
        close = join_crowded(pairs, size.select(F.col("doc").alias("a"), F.col("n").alias("na")), "a", "b", pivots).join(size.select(F.col("doc").alias("b"), F.col("n").alias("nb")), "b")
        close = close.where(100 * F.least("na", "nb") >= hundred * F.greatest("na", "nb")).select("a", "b")
        close = attach(close, registers, "registers").mapInArrow(likely, "a long, b long")
        return attach(close, sets, "hashes").mapInArrow(confirm, "a long, b long")

    checked = C.materialize(members.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct(), "pairs")
    pivots = crowded_keys(checked, "a")
    links = C.materialize(verified(checked), "links")
    component = C.connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst")), "near-components")
    # Any two members of a bucket lie in one group here, whether or not they are similar.
    group = C.connected_components(checked.select(F.col("a").alias("src"), F.col("b").alias("dst")), "near-groups")
    tagged = group.select(F.col("node").alias("doc"), F.col("component").alias("grp")).join(component.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    weighed = tagged.join(registers.select("doc", (F.col("n") * 8).alias("bytes")), "doc")
    sizes = weighed.groupBy("grp", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    sizes = sizes.groupBy("grp").agg(F.sum("n").alias("total"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "component", "bytes")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    enough = lambda n, size: F.greatest(F.ceil(n / tile), F.ceil(size / tile_bytes)).cast("int")
    outside = enough(F.col("total") - F.col("top.n"), F.col("bytes") - F.col("top.bytes"))
    sizes = sizes.select("grp", F.col("top.component").alias("largest"), enough(F.col("total"), F.col("bytes")).alias("tiles"), outside.alias("outer"))
    open_ = C.materialize(join_crowded(tagged, sizes, "grp", "doc", crowded_keys(tagged, "grp")), "open")
    spread = lambda seed, column: F.pmod(F.xxhash64("doc", F.lit(seed)), F.col(column).cast("long")).cast("int")
    full = open_.join(sets, "doc")
    inner = _packed(full.withColumn("tile", spread(1, "tiles")))
    outer = _packed(full.where("component <> largest").withColumn("tile", spread(2, "outer"))).join(sizes.select("grp", "tiles"), "grp")
    left = outer.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select("grp", "other", *PACKED)
    right = inner.select("grp", F.col("tile").alias("other"), *[F.col(c).alias(f"{c}2") for c in PACKED])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                docs, root = tile_links({c: r[c] for c in PACKED}, {c: r[f"{c}2"] for c in PACKED}, hundred)
                yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(root)], ["a", "b"])

    more = C.materialize(left.join(right, ["grp", "other"]).select(*PACKED, *[f"{c}2" for c in PACKED]).mapInArrow(compare, "a long, b long"), "links")
    if not more.isEmpty():
        component = C.connected_components(links.unionByName(more).select(F.col("a").alias("src"), F.col("b").alias("dst")), "near-components")

    C.discard(docs.sparkSession, members, sets, checked, links, open_, more)
    roots = classes.select("name", F.col("doc_id").alias("node")).join(component, "node", "left").select("name", F.coalesce("component", "node").alias("root"))
    out = signed.select("doc_id", "n", "name").join(roots, "name", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("component_id") == F.col("doc_id"))


def op8(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, least=85)
