"""Repeated word windows removed with a compressed FM-index per shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.suffix_array_dedup import window_starts
from marquee.llm.windows import Block, Windows, covered_spans, removed_text


class WaveletMatrix:
    """Rank over a sequence of small integers: one bit vector per binary digit, 64 bits to a word, with a count before each word."""

    def __init__(self, values: np.ndarray, bits: int):
        self.n, self.levels = len(values), []
        for level in range(bits - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            words = np.packbits(np.concatenate((bit, np.zeros(-len(bit) % 64 + 64, bool))), bitorder="little").view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words))[:-1])).astype(np.uint32)
            zeros = int(len(bit) - bit.sum())
            self.levels.append((level, words, before, zeros))
            values = np.concatenate((values[~bit], values[bit]))

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[w].astype(np.int64) + np.bitwise_count(words[w] & mask).astype(np.int64)

    def rank(self, value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of each value before lo and before hi, as places in the last level's order."""
        for level, words, before, zeros in self.levels:
            bit = ((value >> level) & 1).astype(bool)
            a, b = self._ones(words, before, lo), self._ones(words, before, hi)
            lo, hi = np.where(bit, zeros + a, lo - a), np.where(bit, zeros + b, hi - b)
        return lo, hi


class FMIndex:
    """An FM-index of contexts laid end to end, each ended by a separator of its own."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, depth: int):
        self.alphabet, ids = np.unique(symbols, return_inverse=True)
        m, n = len(sizes), len(symbols) + len(sizes)
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = ids + 1
        rank = text + (m - 1)
        rank[ends] = np.arange(m)  # separators differ, so no comparison passes one
        order = np.argsort(rank, kind="stable")
        rank[order] = _dense(rank[order])
        reach, most = 1, int(sizes.max(initial=0)) + 1
        while reach < most:
            later = np.zeros(n, np.int64)
            later[: n - reach] = rank[reach:] + 1
            key = (rank << np.int64(32)) | later
            order = np.argsort(key)
            rank[order] = _dense(key[order])
            reach *= 2
            if rank[order[-1]] == n - 1:
                break
        self.order, self.text = order, text
        before = text[order - 1]
        bits = max(1, int(len(self.alphabet)).bit_length())
        self.wavelet = WaveletMatrix(before, bits)
        # Where rank() places a value's first occurrence, and where its suffixes begin.
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        self.first = np.cumsum(counts) - counts
        zero = np.zeros(len(counts), np.int64)
        self.base = self.wavelet.rank(np.arange(len(counts)), zero, zero)[0]
        # Rows that agree on `depth` words, and on one less: heads and ends of such classes.
        self.classes = {k: self._classes(k) for k in (depth - 1, depth)}

    def _classes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.order)
        padded = np.concatenate((self.text, np.zeros(depth + 1, np.int64)))
        same = np.ones(n, bool)
        a, b = self.order, np.roll(self.order, 1)
        for i in range(depth):
            rows = np.flatnonzero(same)
            x, y = padded[a[rows] + i], padded[b[rows] + i]
            same[rows] = (x == y) & (x != 0)
        same[0] = False
        heads = np.flatnonzero(~same)
        number = np.cumsum(~same) - 1
        return heads[number], np.append(heads[1:], n)[number]

    def extend(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: suffixes that begin with ``value`` followed by what the interval holds."""
        a, b = self.wavelet.rank(value, lo, hi)
        return self.first[value] + a - self.base[value], self.first[value] + b - self.base[value]

    def encode(self, symbols: np.ndarray) -> np.ndarray:
        """Word numbers; 0 for words that the index doesn't hold."""
        if not len(self.alphabet):
            return np.zeros(len(symbols), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, symbols), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == symbols, at + 1, 0)

    def matching_statistics(self, symbols: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each position of each streamed sequence: length of the longest match up to ``depth`` words, and its rows.

        All sequences are read from right to left at once. A match of ``depth`` words first gives up its last
        word (its rows widen to the class of ``depth - 1``), then takes in the word before. Where that
        fails, the longest match that begins at the word is searched for by halving its length.
        """
        values, total = self.encode(symbols), int(sizes.sum())
        length, low, high = (np.zeros(total, np.int64) for _ in range(3))
        ends = np.cumsum(sizes)
        lanes = np.argsort(-sizes, kind="stable")
        n = len(self.order)
        lo, hi, matched = np.zeros(len(lanes), np.int64), np.full(len(lanes), n), np.zeros(len(lanes), np.int64)
        head, tail = self.classes[depth - 1]
        for step in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes[lanes], -step, side="left"))
            at = ends[lanes[:live]] - 1 - step
            v, left, right, m = values[at], lo[:live], hi[:live], matched[:live]
            full = m >= depth
            row = np.minimum(left, n - 1)
            left, right, m = np.where(full, head[row], left), np.where(full, tail[row], right), np.where(full, depth - 1, m)
            a, b = self.extend(left, right, v)
            found = (a < b) & (v > 0)
            a, b, m = np.where(found, a, 0), np.where(found, b, n), np.where(found, m + 1, 0)
            lost = np.flatnonzero(~found & (v > 0))
            if len(lost):
                a[lost], b[lost], m[lost] = self._longest(values, at[lost], np.where(full, depth - 1, matched[:live])[lost])
            lo[:live], hi[:live], matched[:live] = a, b, m
            length[at], low[at], high[at] = m, a, b
        return length, low, high

    def _longest(self, values: np.ndarray, start: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and length of the longest match, of ``most`` words at most, that begins at each start."""
        low, high = np.ones(len(start), np.int64), np.maximum(most, 1)
        while (low < high).any():
            middle = (low + high + 1) // 2
            a, b = self._rows(values, start, middle)
            low, high = np.where(a < b, middle, low), np.where(a < b, high, middle - 1)
        return *self._rows(values, start, low), low

    def _rows(self, values: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(self.order))
        for step in range(int(size.max(initial=0))):
            live = np.flatnonzero((step < size) & (lo < hi))
            v = values[start[live] + size[live] - 1 - step]
            a, b = self.extend(lo[live], hi[live], v)
            lo[live], hi[live] = a, np.where(v > 0, b, a)
        return lo, hi


def _dense(ordered: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate(([0], (ordered[1:] != ordered[:-1]).astype(np.int64)))) if len(ordered) else ordered


def earlier_window(length: int):
    def find(symbols: np.ndarray, sizes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        index = FMIndex(symbols, sizes, length)
        at, owner = window_starts(sizes, length)
        matched, low, _ = index.matching_statistics(symbols, sizes, length)
        # The earliest window of each row class: (doc_id, start) as one number, ids by their rank.
        ranks = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        key = (ranks[owner] << np.int64(36)) + starts[owner] + (at - (np.cumsum(sizes) - sizes)[owner])
        most = np.int64(2**63 - 1)
        by_place = np.full(len(index.text), most)
        by_place[at + owner] = key  # a separator follows every context
        heads = np.flatnonzero(index.classes[length][0] == np.arange(len(index.order)))
        least = np.minimum.reduceat(by_place[index.order], heads)
        first = least[np.searchsorted(heads, low[at], side="right") - 1]
        return (matched[at] >= length) & (first < key)

    return find


def remove_repeated_windows(docs: DataFrame, length: int = 20, gram: int = 8, block_bytes: int = 4 << 20) -> DataFrame:
    """Removes every word covered by a window of ``length`` words whose sequence also starts earlier.

    Words are runs of anything but space and U+0009 to U+000D, unchanged. Earlier: a smaller doc_id, or an
    earlier start in the same document. Windows are judged on the input. Words are compared by 64-bit
    hashes, so two windows pass for equal only if ``length`` word hashes agree one by one.
    Reads doc_id and text; returns doc_id, n_words, n_removed, spans (removed word runs, end exclusive) and
    kept (the other words joined by one space).

    * null and empty texts: no words; texts of fewer than ``length`` words lose nothing; texts are read whole;
    * rows of null doc_id have no place in the order and are left out;
    * rows that share a doc_id are reported each; windows of the same id and start don't remove each other.
    """

    def cut(block: Block, covered: np.ndarray) -> pa.Table:
        data, bounds = block.parts["data"], block.bounds
        starts, ends = block.parts["starts"], block.parts["ends"]
        a, b, number, before = covered_spans(covered, bounds)
        base = bounds[np.searchsorted(bounds, a, side="right") - 1]
        spans = pa.ListArray.from_arrays(pa.array(number, pa.int32()), pa.StructArray.from_arrays([pa.array(a - base), pa.array(b - base)], ["start", "end"]))
        keep = np.flatnonzero(~covered)
        words = np.diff(np.searchsorted(keep, bounds))
        edges = np.concatenate(([0], np.cumsum(words)))
        full = words > 0
        spaced = np.ones(len(keep), bool)
        spaced[edges[1:][full] - 1] = False  # no space after a document's last word
        change = np.zeros(len(data) + 1, np.int8)
        change[starts[keep]] += 1
        change[ends[keep]] -= 1
        inside = np.cumsum(change[:-1], dtype=np.int8) > 0
        space = ends[keep[spaced]]  # a separator follows every other word
        letters = data.copy()
        letters[space], inside[space] = 0x20, True
        size = np.concatenate(([0], np.cumsum(ends[keep] - starts[keep] + spaced)))
        kept = C.bytes_column(letters[inside], size[edges])
        return pa.table({"doc_id": pa.array(block.ids), "n_words": np.diff(bounds), "n_removed": np.diff(before), "spans": spans, "kept": kept})

    spec = Windows(length=length, gram=gram, words=True, by_start=True)
    return removed_text(docs, spec, earlier_window(length), cut, "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept binary", block_bytes)


def op1(spark, sf_dir: str) -> DataFrame:
    out = remove_repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
