"""Packing of tokenised documents into sequences of bounded length with balanced attention cost."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.bpe import Encoder, default_path, slices


def sequence_rooms(total: int, capacity: int) -> np.ndarray:
    """Lengths of the sequences for ``total`` tokens: full ones, and powers of two for what is left, so none is padded."""
    rest = total % capacity
    return np.array([capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1], np.int64)


def balance(sizes: np.ndarray, capacity: int, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece.

    A piece of n tokens costs ``n + quadratic * n * n``. Documents longer than a sequence give whole
    sequences first. The rest goes in descending order to the cheapest sequence with room for it; one that
    fits nowhere is cut at the cheapest sequence with any room.
    """
    rooms = sequence_rooms(int(sizes.sum()), capacity)
    cost, used = np.zeros(len(rooms)), np.zeros(len(rooms), np.int64)
    free = rooms.copy()
    out, tail, next_full = [], [], 0

    def put(doc: int, start: int, n: int, s: int) -> None:
        out.append((doc, start, n, s, int(used[s])))
        used[s] += n
        free[s] -= n
        cost[s] += n + quadratic * n * n

    for doc, n in enumerate(sizes.tolist()):
        start = 0
        while n - start >= capacity:
            put(doc, start, capacity, next_full)
            next_full += 1
            start += capacity
        if n > start:
            tail.append((doc, start, n - start))
    tail.sort(key=lambda x: -x[2])
    for doc, start, n in tail:
        while n:
            fits = np.flatnonzero(free >= n)
            if len(fits):
                put(doc, start, n, int(fits[np.argmin(cost[fits])]))
                break
            some = np.flatnonzero(free > 0)
            s = int(some[np.argmin(cost[some])])
            k = int(free[s])
            put(doc, start, k, s)
            start, n = start + k, n - k
    return out


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, quadratic: float = 1 / 2048, group_bytes: int = 2 << 20) -> DataFrame:
    """Packs all documents: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document is its ids and then ``end_id``. Documents are dealt into groups of about ``group_bytes`` of
    text, packed each for itself; a group's sequences are full but for powers of two at its end (those of the binary
    digits of its last, incomplete sequence: a dozen at most beside some 110 full ones), which need no padding. Each id lies in exactly one piece; offsets in a sequence run on from 0.
    Null and empty texts are one token, ``end_id``; texts are encoded whole; repeated and null doc_ids are
    packed row by row.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    groups = max(1, -(-C.text_bytes(docs) // group_bytes))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        kind = np.uint16 if max(len(encoder.bpe.names), end_id) < 1 << 16 else np.uint32
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                ids, bounds = encoder.encode(part.column(1).to_pylist())
                ids = np.insert(ids.astype(kind), bounds[1:], kind(end_id))
                bounds = bounds + np.arange(len(bounds))
                yield pa.RecordBatch.from_arrays([part.column(0), C.bytes_column(ids.view(np.uint8), bounds * ids.itemsize), pa.array(np.full(part.num_rows, ids.itemsize, np.int32))], ["doc_id", "ids", "width"])
        del encoder
        C.trim_memory()

    def assign(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        width = table["width"][0].as_py()
        data, offsets = C.text_buffer(table["ids"])
        ids = data.view(np.uint16 if width == 2 else np.uint32).astype("<u4")
        offsets = offsets // width
        sizes = np.diff(offsets)
        pieces = np.array(balance(sizes, capacity, quadratic), np.int64).reshape(-1, 5)
        doc, start, length, sequence, offset = pieces.T
        at = np.concatenate(([0], np.cumsum(length)))
        take = np.arange(at[-1]) - np.repeat(at[:-1] - offsets[doc] - start, length)
        return pa.table({"doc_id": table["doc_id"].take(pa.array(doc)), "start": start, "length": length, "ids": C.bytes_column(ids[take].view(np.uint8), at * 4), "doc_tokens": sizes[doc], "sequence_id": sequence + (key[0].as_py() << 32), "offset": offset})

    tokens = docs.mapInArrow(encode, "doc_id long, ids binary, width int")
    # Rows are numbered, so that rows of one id spread as well.
    tokens = tokens.withColumn("g", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(groups)).cast("int")).repartition(C.partitions(groups), "g")
    return tokens.groupBy("g").applyInArrow(assign, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op5(spark, sf_dir: str) -> DataFrame:
    out = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
