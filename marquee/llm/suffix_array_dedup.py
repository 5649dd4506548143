"""Exact repeated-substring removal over bytes, by suffix arrays refined through bucket pointers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.windows import Block, Windows, covered_spans, removed_text


def bucket_pointers(symbols: np.ndarray, depth: int, first: int = 8) -> np.ndarray:
    """For each position a pointer to its bucket: equal where ``depth`` bytes are equal, ordered as those bytes are.

    Buckets begin as sorted q-grams. A refinement sorts only the members of buckets that hold several
    positions, by the pointers ``reach`` bytes later; the new pointers serve the next refinement, so each
    one doubles the depth. A pointer is the place of its bucket's head in the order of all suffixes.
    Positions with less than ``depth`` bytes left compare as if zero bytes followed.
    """
    n = len(symbols)
    first = min(first, depth)
    padded = np.concatenate((symbols, np.zeros(depth, np.uint8)))
    gram = np.zeros(n, np.uint64)
    for i in range(first):
        gram = (gram << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(gram)
    heads = _heads(gram[order])
    pointer = np.zeros(n + depth, np.int64)
    pointer[order] = heads
    reach = first
    while reach < depth:
        step = min(reach, depth - reach)
        place = np.arange(n)
        several = np.zeros(n, bool)
        several[1:] = heads[1:] == heads[:-1]
        several[:-1] |= several[1:]
        place, member = place[several], order[several]
        if not len(member):
            break
        key = (pointer[member] << np.int64(32)) | pointer[member + step]
        again = np.argsort(key)
        member, key = member[again], key[again]
        order[place] = member
        own = np.concatenate(([True], key[1:] != key[:-1]))
        heads[place] = place[np.maximum.accumulate(np.where(own, np.arange(len(own)), 0))]
        pointer[member] = heads[place]
        reach += step
    return pointer[:n]


def _heads(values: np.ndarray) -> np.ndarray:
    n = len(values)
    own = np.concatenate(([True], values[1:] != values[:-1])) if n else np.zeros(0, bool)
    return np.maximum.accumulate(np.where(own, np.arange(n), 0)) if n else np.zeros(0, np.int64)


def window_starts(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all window starts in contexts laid end to end, and the context of each."""
    counts = sizes - length + 1
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), counts)
    return np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[owner], owner


def earlier_document(length: int):
    def find(symbols: np.ndarray, sizes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        at, owner = window_starts(sizes, length)
        bucket, mine = bucket_pointers(symbols, length)[at], ids[owner]
        order = np.argsort(bucket)
        heads = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
        low = np.repeat(np.minimum.reduceat(mine[order], heads), np.diff(np.append(heads, len(order))))
        out = np.empty(len(at), bool)
        out[order] = mine[order] > low
        return out

    return find


def remove_repeated_bytes(docs: DataFrame, length: int = 50, gram: int = 25, whole_characters: bool = False, block_bytes: int = 4 << 20, carry: Column | None = None) -> DataFrame:
    """Removes every byte covered by a ``length``-byte string that also starts in a document of smaller id.

    Reads ``doc_id`` and ``text`` of ``docs``; other columns may have any name. Returns doc_id, n_bytes,
    n_removed, spans (maximal removed runs, byte offsets, end exclusive) and kept (the remaining bytes).
    Judged on the input, not on what is left; overlapping matches count.

    * null text: empty; empty and short texts lose nothing; a text of any length is read whole;
    * rows of null doc_id have no place in the order and are left out;
    * rows that share a doc_id are reported each and never remove each other's bytes;
    * ``carry`` is one more column to return beside each row;
    * ``whole_characters`` keeps characters of which only a part is covered, so that kept stays UTF-8.
    """

    def cut(block: Block, covered: np.ndarray) -> pa.Table:
        data, offsets = block.parts["data"], block.parts["offsets"]
        if whole_characters and len(data):
            head = np.flatnonzero((data & 0xC0) != 0x80)
            covered = np.repeat(np.minimum.reduceat(covered, head), np.diff(np.append(head, len(data)))) if len(head) else covered
        a, b, bounds, before = covered_spans(covered, offsets)
        base = offsets[np.searchsorted(offsets, a, side="right") - 1]
        spans = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(a - base), pa.array(b - base)], ["start", "end"]))
        kept = C.bytes_column(data[~covered], offsets - before)
        return pa.table({"doc_id": pa.array(block.ids), "n_bytes": np.diff(offsets), "n_removed": np.diff(before), "spans": spans, "kept": kept})

    spec = Windows(length=length, gram=gram, words=False, by_start=False)
    return removed_text(docs, spec, earlier_document(length), cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary", block_bytes, carry=carry)


def op7(spark, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
