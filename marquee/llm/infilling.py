"""Fill-in-the-middle rearrangement of documents, cut at word units found through shared content-defined chunks."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.bpe import slices

#: Fixed marks of the three parts.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: A chunk may end where the hash of so many bytes is a multiple of a power of two.
WINDOW = 16
_VALUES = C.BYTE_VALUES.astype(np.uint32)
_FACTOR = 0x9E3779B1


def chunk_ends(data: np.ndarray, offsets: np.ndarray, bits: int) -> np.ndarray:
    """Where chunks end: at the end of every text and after each window whose rolling hash has ``bits`` leading zeros.

    Of a run of such windows only the first counts, so long runs of one byte stay one chunk. Windows never reach
    into the text before, so equal passages give equal chunks but for those at their edges.
    """
    h, factor, step = _VALUES[data], _FACTOR, 1
    while step < WINDOW:
        h[step:] += h[:-step] * np.uint32(factor)
        factor, step = factor * factor % (1 << 32), 2 * step
    hit = h >> np.uint32(32 - bits) == 0
    hit[1:] &= ~hit[:-1]
    ends = np.flatnonzero(hit) + 1
    ends = ends[ends - offsets[np.searchsorted(offsets, ends, side="left") - 1] >= WINDOW]
    return np.union1d(ends, offsets[1:][np.diff(offsets) > 0])


class ChunkSummaries:
    """What each distinct chunk holds, by its content: runs of non-spaces, code points, and whether it begins and ends inside a run.

    A chunk is looked up by its bytes (so equal hashes never stand for equal content) and read only when it is new;
    at most ``most_bytes`` of chunks are held, then the cache starts anew.
    """

    def __init__(self, most_bytes: int = 64 << 20):
        self.most_bytes = most_bytes
        self._clear()

    def _clear(self) -> None:
        self.index: defaultdict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.known, self.held = 0, 0
        self.table = np.zeros((0, 4), np.int64)

    def of(self, chunks: list[bytes]) -> np.ndarray:
        """A row (runs, code points, begins inside a run, ends inside one) for each chunk."""
        if self.held > self.most_bytes:
            self._clear()
        codes = [self.index[x] for x in chunks]
        new = list(self.index)[self.known :]
        if new:
            data = np.frombuffer(b"".join(new), np.uint8)
            starts = np.concatenate(([0], np.cumsum([len(x) for x in new])))
            inside = ~C.SEPARATORS[data]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            first[starts[:-1]] = inside[starts[:-1]]
            runs = np.add.reduceat(first.astype(np.int64), starts[:-1])
            points = np.add.reduceat((data & 0xC0 != 0x80).astype(np.int64), starts[:-1])
            self.table = np.concatenate((self.table, np.stack((runs, points, inside[starts[:-1]], inside[starts[1:] - 1]), axis=1)))
            self.known, self.held = len(self.index), self.held + len(data)
        return self.table[codes]


class Units:
    """Units of the texts in one buffer: spaces and the run of non-spaces after them; trailing spaces are a unit of their own."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, cache: ChunkSummaries, bits: int):
        self.data, self.offsets = data, offsets
        self.ends = chunk_ends(data, offsets, bits)
        self.starts = np.concatenate(([0], self.ends))[:-1]
        raw = data.tobytes()
        summary = cache.of([raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True)])
        runs, points, begins, closes = summary.T
        #: The chunks of text d are bounds[d] to bounds[d + 1].
        self.bounds = np.searchsorted(self.starts, offsets)
        joined = np.zeros(len(runs), np.int64)  # the run at a chunk's end goes on in the next one
        joined[:-1] = closes[:-1] & begins[1:]
        joined[self.bounds[1:][self.bounds[1:] > 0] - 1] = 0
        self.done = np.concatenate(([0], np.cumsum(runs - joined)))  # runs that have ended, over all texts
        self.points = np.concatenate(([0], np.cumsum(points)))
        full = np.diff(offsets) > 0
        tail = np.zeros(len(full), np.int64)
        tail[full] = closes[self.bounds[1:][full] - 1] == 0
        self.runs = self.done[self.bounds[1:]] - self.done[self.bounds[:-1]]
        self.counts = self.runs + tail

    def end(self, d: int, m: int) -> tuple[int, int]:
        """Bytes and code points of text d up to the end of its m-th unit; only the chunk that holds the place is read."""
        if m == 0:
            return 0, 0
        low, high = int(self.bounds[d]), int(self.bounds[d + 1])
        if m > self.runs[d]:
            return int(self.offsets[d + 1] - self.offsets[d]), int(self.points[high] - self.points[low])
        target = self.done[low] + m
        j = low + int(np.searchsorted(self.done[low + 1 : high + 1], target))
        chunk = self.data[self.starts[j] : self.ends[j]]
        inside = ~C.SEPARATORS[chunk]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        at = int(np.flatnonzero(stops)[target - self.done[j] - 1]) + 1
        return int(self.starts[j] + at - self.offsets[d]), int(self.points[j] - self.points[low] + np.count_nonzero(chunk[:at] & 0xC0 != 0x80))


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers of 32 bits from the document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, plain_percent: int = 50, spm_percent: int = 80, bits: int = 9) -> DataFrame:
    """Every whole text, rearranged: doc_id, n (units), form (plain, spm, psm), prefix_chars, middle_chars, output.

    Two places drawn from the id part the units into prefix, middle and suffix. A text that is empty or holds a
    mark stays plain, and so do those of the drawn share. Texts are cut into content-defined chunks; a chunk that
    comes again in a task is counted once, and a document's places are found from the counts of its chunks.
    Nothing is shuffled: each row stands for itself, so repeated ids give a row each; a null id draws as an empty
    one. Null text counts as empty.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    fields = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkSummaries()
        for batch in batches:
            for part in slices(batch, 1):
                data, offsets = C.text_buffer(part.column(1))
                units = Units(data, offsets, cache, bits)
                forms, prefixes, middles, outputs = [], [], [], []
                for d, doc_id in enumerate(part.column(0).to_pylist()):
                    text = data[offsets[d] : offsets[d + 1]].tobytes()
                    h1, h2, h3, h4 = draws(doc_id, seed)
                    if not text or h3 % 100 >= plain_percent or PREFIX in text or SUFFIX in text or MIDDLE in text:
                        form, before, within, out = "plain", None, None, (text,)
                    else:
                        n = int(units.counts[d]) + 1
                        (a, before), (b, until) = (units.end(d, m) for m in sorted((h1 % n, h2 % n)))
                        form, within = "spm" if h4 % 100 < spm_percent else "psm", until - before
                        first, last = (PREFIX, text[:a]), (SUFFIX, text[b:])
                        out = (*last, *first, MIDDLE, text[a:b]) if form == "spm" else (*first, *last, MIDDLE, text[a:b])
                    forms.append(form)
                    prefixes.append(before)
                    middles.append(within)
                    outputs.append(b"".join(out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(units.counts), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
                    [f.split()[0] for f in fields.split(", ")],
                )

    return docs.mapInArrow(run, fields)


def restored(output: str = "output", form: str = "form"):
    """The text that an output was made of. No text that was rearranged holds a mark, so its output parts at the three marks alone."""
    parts = F.split(F.col(output), "<[PSM]>")
    return F.when(F.col(form) == "plain", F.col(output)).when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))


def op12(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))
