"""Repeated fixed-length windows over all documents, found without comparing documents pairwise.

A window is ``length`` consecutive symbols (bytes or word hashes) of one document. Its *anchor* is the
leftmost smallest hash among the ``gram``-symbol strings inside it, so equal windows have equal anchors.
About one position in ``(length - gram) / 2`` is an anchor, and only those travel:

1. each block of documents sends its distinct anchor hashes, packed, to shards by hash;
2. a shard answers with one bit per hash: does it occur anywhere else; and lists its hot hashes;
3. a block sends the text around its shared anchors (once per distinct text) to the shard of the anchor;
4. the shard decides for every window whether an equal one starts earlier, by the index that the
   operator supplies, and answers with one bit per window;
5. the block cuts its documents.

A hash or passage that a third of all documents hold reaches a shard once per block, not once per document, while
its surroundings are equal. Where they differ, one hash has a context for each document: hashes whose contexts may hold
more than PART symbols are *hot*. Their windows travel one by one, to the shard of a hash of the whole window, so equal
windows still meet and the others spread.
There is a block for every ``block_bytes`` of text and a shard for every two blocks, dealt over as many partitions as there
are blocks, so neither outgrows a task. A block sends a shard one packed row, so rows number blocks times shards, and never more than
anchors: past some terabytes a packed row holds only a few hashes, and the shuffle is that of a row for each anchor.
Blocks are of bounded size but for a single longer text, which is a block of its own and takes some 16 bytes of
memory for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C

#: One value per window start: True where an equal window starts earlier.
Finder = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
CHUNK = 1 << 16
PART = 1 << 19
#: Windows with one anchor make one run; where ties go on (one byte repeated), runs are cut at so many times the usual length.
LONGEST = 8
#: Blocks for each shard.
BLOCKS_A_SHARD = 2


def portions(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of consecutive items with about ``most`` of the summed sizes each, one item at least."""
    part = (np.cumsum(sizes) - sizes) // most
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])) if len(part) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield slice(a, b)


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of spans end to end."""
    return np.arange(int(size.sum())) + np.repeat(begin - (np.cumsum(size) - size), size)


def distinct_spans(symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each (non-empty) span's content, in the order of first appearance, and the first span of each.

    Spans meet by a hash and are then compared symbol by symbol; one that only shares its hash stands for itself.
    """
    n = len(begin)
    h, differ = np.zeros(n, np.uint64), np.zeros(n, bool)
    for p in portions(size, CHUNK):
        at = np.cumsum(size[p]) - size[p]
        x = symbols[spread(begin[p], size[p])]
        x = C.BYTE_VALUES[x] if symbols.dtype == np.uint8 else x
        h[p] = C.mix(np.add.reduceat(x * C.powers(int(size[p].max()))[spread(np.zeros_like(at), size[p])], at) + size[p].astype(np.uint64))
    _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    leader = first[inverse]
    differ = size != size[leader]
    rest = np.flatnonzero(~differ & (leader != np.arange(n)))
    for p in portions(size[rest], CHUNK):
        mine = rest[p]
        unequal = symbols[spread(begin[mine], size[mine])] != symbols[spread(begin[leader[mine]], size[mine])]
        differ[mine] = np.logical_or.reduceat(unequal, np.cumsum(size[mine]) - size[mine])
    leader[differ] = np.flatnonzero(differ)
    own = leader == np.arange(n)
    return (np.cumsum(own) - 1)[leader], np.flatnonzero(own)


@dataclass(frozen=True)
class Windows:
    length: int
    gram: int
    words: bool  # symbols are words, not bytes
    by_start: bool  # an earlier start in the same document counts too

    @property
    def span(self) -> int:
        return self.length - self.gram + 1

    def symbols(self, column) -> dict:
        data, offsets = C.text_buffer(column)
        if not self.words:
            return {"data": data, "offsets": offsets, "symbols": data, "bounds": offsets}
        starts, ends, bounds = C.find_words(data, offsets)
        return {"data": data, "offsets": offsets, "symbols": C.hash_spans(data, starts, ends), "bounds": bounds, "starts": starts, "ends": ends}

    def gram_hashes(self, symbols: np.ndarray) -> np.ndarray:
        """A hash for each gram; grams by doubling, so the work is logarithmic in their length."""
        whole, at, size = None, 0, 1
        h = C.BYTE_VALUES[symbols] if symbols.dtype == np.uint8 else symbols
        left = self.gram
        while True:
            if left & 1:
                n = len(symbols) - self.gram + 1
                part = h[at : at + n]
                whole = part.copy() if whole is None else whole * np.uint64(0xD6E8FEB86659FD93) + part
                at += size
            left >>= 1
            if not left:
                return C.mix(whole)
            h = h[:-size] * np.uint64(0xA0761D6478BD642F + 2 * size) + h[size:]
            size *= 2

    def runs(self, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last window start of each run whose anchors have one hash, the hash, where the first anchor is, and whether later ones lie elsewhere."""
        n, firsts, lasts, keys, places, several = len(symbols), [], [], [], [], []
        sizes = np.diff(bounds)
        good = np.maximum(sizes - self.length + 1, 0)
        valid = np.repeat(np.tile(np.array([True, False]), len(sizes)), np.stack((good, sizes - good), axis=1).ravel())
        for at in range(0, n - self.length + 1, CHUNK):
            stop = min(at + CHUNK, n - self.length + 1)
            h = self.gram_hashes(symbols[at : stop + self.length - 1])
            low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
            size = 1
            while size < self.span:
                step = min(size, self.span - size)
                low = np.minimum(low[:-step], low[step:])
                size += step
            place = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
            ok, own = valid[at:stop], h[place]
            head = ok.copy()
            head[1:] &= (own[1:] != own[:-1]) | ~ok[:-1]
            every = np.arange(len(ok))
            head |= ok & ((every - np.maximum.accumulate(np.where(head, every, 0))) % (LONGEST * self.span) == 0)
            first = np.flatnonzero(head)
            if not len(first):
                continue
            last = first + np.add.reduceat(ok.astype(np.int32), first) - 1
            firsts.append(first + at)
            lasts.append(last + at)
            places.append(place[first] + at)
            several.append(place[first] != place[last])
            keys.append(C.mix(own[first] ^ np.uint64(0x5851F42D4C957F2D)))
        if not firsts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(x) for x in (firsts, lasts, keys, places, several))

    def window_hashes(self, symbols: np.ndarray, start: np.ndarray) -> np.ndarray:
        """A hash of the whole window at each start."""
        whole = np.zeros(len(start), np.uint64)
        for i in range(self.length):
            x = symbols[start + i]
            whole = whole * np.uint64(0xD6E8FEB86659FD93) + (C.BYTE_VALUES[x] if symbols.dtype == np.uint8 else x)
        return C.mix(whole)


class Block:
    """One block of documents in the order of their ids, with its runs. Built alike in every pass."""

    def __init__(self, table: pa.Table, spec: Windows, shards: int):
        table = table.set_column(table.schema.get_field_index("text"), "text", C.pc.fill_null(table["text"], ""))
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.carry = table["carry"] if "carry" in table.schema.names else None
        self.spec, self.ids = spec, np.asarray(table["doc_id"].to_numpy())
        self.parts = spec.symbols(table["text"])
        self.symbols, self.bounds = self.parts["symbols"], self.parts["bounds"]
        self.first, self.last, key, self.place, self.several = spec.runs(self.symbols, self.bounds)
        self.doc = np.searchsorted(self.bounds, self.first, side="right") - 1
        self.shards = np.uint64(shards)
        self.code = self.coded(key)
        self.order = np.argsort(self.code, kind="stable")
        sorted_codes = self.code[self.order]
        new = np.concatenate(([True], sorted_codes[1:] != sorted_codes[:-1])) if len(sorted_codes) else np.zeros(0, bool)
        self.heads = np.flatnonzero(new)
        self.codes = sorted_codes[self.heads]
        self.rank = np.empty(len(self.code), np.int64)
        self.rank[self.order] = np.cumsum(new) - 1

    def coded(self, key: np.ndarray) -> np.ndarray:
        """Shard and 32 bits of each hash."""
        return ((key % self.shards) << np.uint64(32)) | (key >> np.uint64(32))

    def counts(self) -> np.ndarray:
        """Contexts of each distinct hash; equal ones of a frequent hash count once."""
        out = np.diff(np.append(self.heads, len(self.code)))
        run = np.flatnonzero((out > 64)[self.rank])
        if len(run):
            mine = self.rank[run[self.contexts(run)[1]]]
            out[out > 64] = np.bincount(mine, minlength=len(out))[out > 64]
        return out

    def repeated(self) -> np.ndarray:
        """For each distinct hash: does it recur within this block."""
        x = (self.place if self.spec.by_start else self.doc_key())[self.order]
        low = np.minimum.reduceat(x, self.heads) if len(self.heads) else x
        high = np.maximum.reduceat(x, self.heads) if len(self.heads) else x
        again = low != high
        if self.spec.by_start:
            again[self.rank[self.several]] = True
        return again

    def doc_key(self) -> np.ndarray:
        return self.ids[self.doc]

    def shard_slices(self, codes: np.ndarray) -> Iterator[tuple[int, slice]]:
        shard = (codes >> np.uint64(32)).astype(np.int64)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)])) if len(shard) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(shard[a]), slice(int(a), int(b))

    def shared(self, answers: dict[int, tuple[bytes, bytes]]) -> np.ndarray:
        """Runs whose anchor occurs elsewhere, ordered by shard, once those of hot anchors are split into windows.

        Answers hold a bit for each distinct hash of a shard, and the shard's hot hashes.
        """
        bits, hot = np.zeros(len(self.codes), dtype=bool), np.zeros(len(self.codes), dtype=bool)
        for shard, part in self.shard_slices(self.codes):
            have, listed = answers[shard]
            bits[part] = np.unpackbits(np.frombuffer(have, np.uint8), count=part.stop - part.start).astype(bool)
            if listed:
                hot[part] = bits[part] & np.isin(self.codes[part].astype(np.uint32), np.frombuffer(listed, np.uint32))
        run = np.flatnonzero(bits[self.rank])
        if hot.any():
            split = hot[self.rank[run]]
            run = self.split(run[~split], run[split])
        return run[np.argsort(self.code[run] >> np.uint64(32), kind="stable")]

    def split(self, whole: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """Keeps only these runs, each of ``hot`` as runs of one window with the code of the whole window; equal windows stay in order."""
        size = self.last[hot] - self.first[hot] + 1
        start = np.repeat(self.first[hot] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        code = self.coded(self.spec.window_hashes(self.symbols, start))
        self.first, self.last = np.concatenate((self.first[whole], start)), np.concatenate((self.last[whole], start))
        self.doc = np.concatenate((self.doc[whole], np.repeat(self.doc[hot], size)))
        self.code = np.concatenate((self.code[whole], code))
        return np.arange(len(self.code))

    def contexts(self, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each run the number of its context (equal contexts share it), and the place in ``run`` of the first run of each."""
        return distinct_spans(self.symbols, self.first[run], self.last[run] - self.first[run] + self.spec.length)


def covered_spans(covered: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal covered spans inside each text, the number of spans and of covered symbols before each text."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[bounds] = True
    head, tail = covered & edge[:-1], covered & edge[1:]
    head[1:] |= covered[1:] & ~covered[:-1]
    tail[:-1] |= covered[:-1] & ~covered[1:]
    a, b = np.flatnonzero(head), np.flatnonzero(tail) + 1
    number = np.searchsorted(a, bounds)
    return a, b, number, np.concatenate(([0], np.cumsum(b - a)))[number]


def _pack(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def removed_text(docs: DataFrame, spec: Windows, finder: Finder, cut: Callable[[Block, np.ndarray], pa.Table], cut_schema: str, block_bytes: int, carry: Column | None = None) -> DataFrame:
    """Runs the five steps; ``cut`` turns a block and its covered symbols into rows of ``cut_schema``.

    ``carry`` is any one column (a struct's fields all nullable) that travels with a document and comes back beside its row.
    """
    extra = [] if carry is None else [carry.alias("carry")]
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *extra).where("doc_id is not null")
    carried = bool(extra)
    if carried:
        cut_schema += f", carry {docs.schema['carry'].dataType.simpleString()}"
    n = max(1, -(-C.text_bytes(docs) // block_bytes))
    shards = -(-n // BLOCKS_A_SHARD)
    blocks = C.with_group(docs, "doc_id", n).repartition(C.partitions(n), "g")
    most = PART // spec.length

    def send_hashes(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = Block(table, spec, shards)
        again, counts = block.repeated(), block.counts()
        several = counts > 1
        schema = pa.schema([("shard", pa.int32()), ("g", pa.int32()), ("hashes", pa.binary()), ("again", pa.binary()), ("several", pa.binary()), ("counts", pa.binary())])
        rows = [(s, key[0].as_py(), block.codes[p].astype(np.uint32).tobytes(), _pack(again[p]), _pack(several[p]), counts[p][several[p]].astype(np.uint32).tobytes()) for s, p in block.shard_slices(block.codes)]
        return pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    def find_shared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()]
        again = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool) for x, p in zip(table["again"].to_pylist(), parts, strict=True)]
        every = np.sort(np.concatenate(parts))
        more = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *(p[a] for p, a in zip(parts, again, strict=True))]))
        # Runs of each hash: one in each block that holds it, and the others of blocks that hold it several times.
        several = [p[np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool)] for x, p in zip(table["several"].to_pylist(), parts, strict=True)]
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
        own, place = np.unique(np.concatenate(several), return_inverse=True)
        total = np.searchsorted(every, own, side="right") - np.searchsorted(every, own) + np.bincount(place, counts - 1, len(own))
        wide = every[most:][every[most:] == every[: len(every) - most]] if len(every) > most else every[:0]
        hot = np.union1d(own[total > most], wide).astype(np.uint32).tobytes()
        bits = []
        for p in parts:
            at = np.minimum(np.searchsorted(more, p), max(len(more) - 1, 0))
            bits.append(_pack(more[at] == p if len(more) else np.zeros(len(p), bool)))
        return pa.table({"g": table["g"], "shard": table["shard"], "bits": pa.array(bits, pa.binary()), "hot": pa.array([hot] * len(bits), pa.binary())})

    def send_contexts(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("shard", pa.int32()), ("g", pa.int32()), ("symbols", pa.binary()), ("lengths", pa.binary()), ("hashes", pa.binary()), ("ids", pa.binary()), ("starts", pa.binary())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        block = Block(left, spec, shards)
        run = block.shared(dict(zip(right["shard"].to_pylist(), zip(right["bits"].to_pylist(), right["hot"].to_pylist(), strict=True), strict=True)))
        lead = run[block.contexts(run)[1]]
        rows = []
        for shard, p in block.shard_slices(block.code[lead]):
            mine = lead[p]
            a, b = block.first[mine], block.last[mine] + spec.length
            rows.append((shard, key[0].as_py(), block.symbols[spread(a, b - a)].tobytes(), (b - a).astype(np.uint32).tobytes(), block.code[mine].astype(np.uint32).tobytes(), block.doc_key()[mine].astype(np.int64).tobytes(), (a - block.bounds[block.doc[mine]]).astype(np.int64).tobytes()))
        return pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    def decide(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        kind = np.uint64 if spec.words else np.uint8
        lists = {c: [np.frombuffer(x, t) for x in table[c].to_pylist()] for c, t in (("symbols", kind), ("lengths", np.uint32), ("hashes", np.uint32), ("ids", np.int64), ("starts", np.int64))}
        sent = [len(x) for x in lists["lengths"]]
        lengths, hashes, ids, starts = (np.concatenate(lists.pop(c)).astype(np.int64) for c in ("lengths", "hashes", "ids", "starts"))
        symbols = np.concatenate(lists.pop("symbols"))
        if not spec.by_start:
            starts = np.zeros_like(starts)
        begins = np.cumsum(lengths) - lengths
        counts = lengths - spec.length + 1
        at = np.cumsum(counts) - counts
        bits = np.zeros(int(counts.sum()), bool)
        order = np.lexsort((starts, ids, hashes))
        # Equal windows have equal hashes (of the anchor, or of the window where that is hot), so the shard is done hash by
        # hash. One hash has contexts of about PART symbols at most, or equal ones, so the number of symbols at a time is bounded.
        part = np.cumsum(lengths[order]) // PART
        head = np.concatenate(([True], np.diff(hashes[order]) != 0))
        part = np.maximum.accumulate(np.where(head, part, 0))
        for mine in np.split(order, np.flatnonzero(np.diff(part)) + 1):
            # Equal contexts of different blocks: only the earliest needs the index, the others are repeats throughout.
            place, own = distinct_spans(symbols, begins[mine], lengths[mine])
            leader = own[place]
            size = lengths[mine[own]]
            hit = finder(symbols[spread(begins[mine[own]], size)], size, ids[mine[own]], starts[mine[own]])
            later = (ids[mine] != ids[mine[leader]]) | (starts[mine] != starts[mine[leader]])
            n_windows, hit_at = counts[mine], np.cumsum(counts[mine[own]]) - counts[mine[own]]
            bits[spread(at[mine], n_windows)] = hit[spread(hit_at[place], n_windows)] | np.repeat(later, n_windows)
        ends = np.concatenate(([0], np.cumsum(counts)))[np.cumsum([0, *sent])]
        out = [_pack(bits[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({"g": table["g"], "shard": table["shard"], "bits": pa.array(out, pa.binary())})

    def apply(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return empty.empty_table()
        block = Block(left, spec, shards)
        answer = {k: {} for k in (0, 1)}
        for step, shard, bits, hot in zip(right["step"].to_pylist(), right["shard"].to_pylist(), right["bits"].to_pylist(), right["hot"].to_pylist(), strict=True):
            answer[step][shard] = bits if step else (bits, hot)
        run = block.shared(answer[0])
        number, lead = block.contexts(run)
        lead = run[lead]
        counts = block.last[lead] - block.first[lead] + 1
        hits = [np.zeros(0, bool)]
        for shard, p in block.shard_slices(block.code[lead]):
            hits.append(np.unpackbits(np.frombuffer(answer[1][shard], np.uint8), count=int(counts[p].sum())).astype(bool))
        hits = np.concatenate(hits)
        at = np.concatenate(([0], np.cumsum(counts)))
        earliest = lead[number]
        later = block.doc_key()[run] != block.doc_key()[earliest]
        if spec.by_start:
            start = block.first - block.bounds[block.doc]
            later |= start[run] != start[earliest]
        change = np.zeros(len(block.symbols) + 1, np.int32)
        full = run[later]
        np.add.at(change, block.first[full], 1)
        np.add.at(change, block.last[full] + spec.length, -1)
        some, which = run[~later], number[~later]
        size = counts[which]
        for p in portions(size, CHUNK):
            begin = spread(block.first[some[p]], size[p])[hits[spread(at[which[p]], size[p])]]
            np.add.at(change, begin, 1)
            np.add.at(change, begin + spec.length, -1)
        out = cut(block, np.cumsum(change[:-1], dtype=np.int32) > 0)
        return out.append_column("carry", block.carry) if carried else out

    empty = pa.schema([])
    hashes = blocks.groupBy("g").applyInArrow(send_hashes, "shard int, g int, hashes binary, again binary, several binary, counts binary")
    shared = hashes.repartition(C.partitions(n), "shard").groupBy("shard").applyInArrow(find_shared, "g int, shard int, bits binary, hot binary")
    contexts = blocks.groupBy("g").cogroup(shared.repartition(C.partitions(n), "g").groupBy("g")).applyInArrow(send_contexts, "shard int, g int, symbols binary, lengths binary, hashes binary, ids binary, starts binary")
    decided = contexts.repartition(C.partitions(n), "shard").groupBy("shard").applyInArrow(decide, "g int, shard int, bits binary")
    answers = shared.select("g", "shard", "bits", "hot", F.lit(0).alias("step")).unionByName(decided.select("g", "shard", "bits", F.lit(None).cast("binary").alias("hot"), F.lit(1).alias("step")))
    return blocks.groupBy("g").cogroup(answers.repartition(C.partitions(n), "g").groupBy("g")).applyInArrow(apply, cut_schema)
