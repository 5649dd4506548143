"""Byte-pair encoding and decoding with a minimal acyclic transducer for frequent words."""

from __future__ import annotations

import heapq
import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C

#: Fixed patterns of the two public tokenizer files: pre-tokens of the word BPE and of the byte-level BPE. Letters come
#: first, which changes nothing (no other alternative begins with one) and is faster.
FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # as the word file states it
WORD_PATTERN = r"\p{L}+|'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII alone (the words in lower case).
WORD_ASCII = r"[a-z]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\t-\r a-z0-9]+"
BYTE_ASCII = r" ?[A-Za-z]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: Fixed ranges that hold every character whose class or case differs between the Unicode tables at hand and the
#: public library's older ones; texts with any of them are split by the library itself.
UNSURE = "[\u0558\u058b\u058c\u088f\u0c5c\u0cdc\u1c89\u208f\u209d-\u209f\ua7cb-\ua7e2\ua7f1\uab6c\uab6d\U00010000-\U0001efff\U0002b700-\U0010ffff]"


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class PairTable:
    """Rank of a pair of ids, vectorised: hash tables of falling size, each with what collided in the one before."""

    def __init__(self, merges: dict[int, tuple[int, int]]):
        keys = np.fromiter(merges, np.int64, len(merges)).astype(np.uint64)
        ranks = np.array([r for r, _ in merges.values()], np.int64)
        self.none = int(ranks.max(initial=0)) + 1
        self.merged = np.zeros(self.none, np.int64)
        self.merged[ranks] = [m for _, m in merges.values()]
        self.levels = []
        while len(keys):
            bits = max(4, int(8 * len(keys)).bit_length())
            multiplier = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.levels))
            slot = self._slot(keys, multiplier, bits)
            owner, first = np.unique(slot, return_index=True)
            table, value = np.full(1 << bits, 2**64 - 1, np.uint64), np.full(1 << bits, self.none, np.int64)
            table[owner], value[owner] = keys[first], ranks[first]
            self.levels.append((multiplier, bits, table, value))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks = keys[rest], ranks[rest]

    @staticmethod
    def _slot(keys: np.ndarray, multiplier: np.uint64, bits: int) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(29))) * multiplier) >> np.uint64(64 - bits)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``none`` where it doesn't merge or an id is negative."""
        keys = (a.astype(np.uint64) << np.uint64(32)) | (b.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        out = np.full(keys.shape, self.none, np.int64)
        for multiplier, bits, table, value in self.levels:
            slot = self._slot(keys, multiplier, bits)
            hit = table[slot] == keys
            out[hit] = value[slot[hit]]
        out[(a < 0) | (b < 0)] = self.none
        return out


class Bpe:
    """A tokenizer file: normalisation, pre-tokens, and exact merges of single pre-tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.folds = spec["normalizer"] is not None
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if not all("<|" in x for x in self.added):
            raise ValueError(f"{path}: an added token without <|")
        before = spec["pre_tokenizer"]
        steps = before.get("pretokenizers", [before])
        words = [(x["pattern"]["Regex"], x["behavior"], x["invert"]) for x in steps if x["type"] == "Split"]
        if words != ([(FILE_PATTERN, "Removed", True)] if self.folds else []) or steps[-1]["type"] != "ByteLevel" or steps[-1]["add_prefix_space"] or steps[-1]["use_regex"] == self.folds:
            raise ValueError(f"{path}: pre-tokens of another kind than the patterns here")
        self.find = regex.compile(WORD_PATTERN if self.folds else BYTE_PATTERN).findall
        self.find_ascii = re.compile(WORD_ASCII if self.folds else BYTE_ASCII).findall
        self.unsure = regex.compile(UNSURE).search
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split
        letters = byte_letters()
        self.byte_ids = [vocab[x] for x in letters]
        self.last_ids = [vocab[x + self.suffix] for x in letters]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        self.pairs = PairTable(self.merges)
        names = {i: x for x, i in vocab.items()} | {i: x for x, i in self.added.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.name_bytes = np.frombuffer(b"".join(self.names), np.uint8)
        self.name_ends = np.concatenate(([0], np.cumsum([len(x) for x in self.names])))

    def fold(self, text: str) -> str:
        if not self.folds:
            return text
        if not text.isascii():
            # Capital sigma folds letter by letter here, whatever stands after it.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text; an added token's string stands for itself."""
        find = self._plain_pieces if text.isascii() or not self.unsure(text) else self._library_pieces
        if "<|" not in text:
            return find(text)
        out: list[str] = []
        for i, part in enumerate(self.split(text)):
            out += ["\0" + part] if i % 2 else find(part)
        return out

    def _plain_pieces(self, text: str) -> list[str]:
        return self.find_ascii(self.fold(text)) if text.isascii() else self.find(self.fold(text))

    def _library_pieces(self, text: str) -> list[str]:
        from tokenizers import Regex, normalizers, pre_tokenizers

        if not self.folds:
            return [text[a:b] for _, (a, b) in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        text = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str(text)
        return [x for x, _ in pre_tokenizers.Split(Regex(WORD_PATTERN), "removed", invert=True).pre_tokenize_str(text)]

    def merge(self, piece: str) -> list[int]:
        """Ids of one pre-token."""
        if piece[0] == "\0" and piece[1:] in self.added:
            return [self.added[piece[1:]]]
        raw = piece.encode("utf-8", "surrogatepass")
        ids = [self.byte_ids[b] for b in raw]
        ids[-1] = self.last_ids[raw[-1]]
        return self._merge_long(ids) if len(ids) > 48 else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get = self.merges.get
        while len(ids) > 1:
            found = [x for x in map(get, [a << 32 | b for a, b in zip(ids, ids[1:], strict=False)]) if x]
            if not found:
                break
            rank, new = min(found)
            out, i, n = [], 0, len(ids)
            while i < n:
                if i + 1 < n and (x := get(ids[i] << 32 | ids[i + 1])) and x[0] == rank:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same merges through a heap, for very long pre-tokens."""
        n, get = len(ids), self.merges.get
        after, before, heap = [*range(1, n), -1], [*range(-1, n - 1)], []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (x := get(ids[i] << 32 | ids[after[i]])):
                heapq.heappush(heap, (x[0], i, ids[i], ids[after[i]], x[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def sizes(self, pieces: list[str]) -> np.ndarray:
        """The number of ids of each pre-token."""
        sizes = np.zeros(len(pieces), np.int64)
        for rows, ids in self._merged(pieces):
            sizes[rows] = (ids >= 0).sum(axis=1)
        return sizes

    def merge_many(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids, end to end, of many pre-tokens."""
        sizes, parts = np.zeros(len(pieces), np.int64), list(self._merged(pieces))
        for rows, ids in parts:
            sizes[rows] = (ids >= 0).sum(axis=1)
        at = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.int32)
        for rows, ids in parts:
            r, c = np.nonzero(ids >= 0)
            out[at[rows[r]] + c] = ids[r, c]
        return sizes, out

    def _merged(self, pieces: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Parts of equal width: word numbers, and ids padded with -1. Each round merges one pair in every word at once."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        lengths = np.array([len(r) for r in raw], np.int64)
        single = np.array([p[0] == "\0" for p in pieces], bool)
        low = 0
        for width in (6, 9, 13, 20, 48):
            rows = np.flatnonzero((lengths > low) & (lengths <= width) & ~single)
            low = width
            if len(rows):
                yield from self._merge_rows(rows, [raw[i] for i in rows.tolist()], lengths[rows], width)
        for i in np.flatnonzero((lengths > 48) | single).tolist():
            yield np.array([i]), np.array(self.merge(pieces[i]), np.int32)[None, :]

    def _merge_rows(self, rows: np.ndarray, words: list[bytes], lengths: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
        n, done = len(words), []
        data = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), lengths)
        column = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ids = np.full((n, width), -1, np.int64)
        ids[row, column] = np.array(self.byte_ids)[data]
        last = lengths - 1
        ids[np.arange(n), last] = np.array(self.last_ids)[data[np.cumsum(lengths) - 1]]
        rank = self.pairs.find(ids[:, :-1], ids[:, 1:])
        places = np.arange(width)
        while n:
            best = rank.argmin(axis=1)
            low = rank[np.arange(n), best]
            live = low < self.pairs.none
            if not live.all():
                done.append((rows[~live], ids[~live].astype(np.int32)))
                rows, ids, rank, best, low = rows[live], ids[live], rank[live], best[live], low[live]
                n = len(rows)
                if not n:
                    break
            every = np.arange(n)
            ids[every, best] = self.pairs.merged[low]
            shift = places[None, :-1] + (places[None, :-1] > best[:, None])
            ids = np.concatenate((np.take_along_axis(ids, shift, axis=1), np.full((n, 1), -1)), axis=1)
            # Ranks left of the merge stay, those right of it move one place; its two neighbours are new.
            shift = np.minimum(places[None, :-1] + (places[None, :-1] >= best[:, None]), width - 2)
            rank = np.take_along_axis(rank, shift, axis=1)
            rank[:, -1] = self.pairs.none
            right = np.minimum(best + 1, width - 1)
            at = np.minimum(best, width - 2)
            rank[every, at] = np.where(best + 1 < width, self.pairs.find(ids[every, best], ids[every, right]), self.pairs.none)
            has = np.flatnonzero(best > 0)
            rank[has, best[has] - 1] = self.pairs.find(ids[has, best[has] - 1], ids[has, best[has]])
        return done

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of each list's token names joined by one space, and where each begins."""
        size = np.diff(self.name_ends)[ids] + 1
        at = np.cumsum(size) - size
        total = int(size.sum())
        inner = np.arange(total) - np.repeat(at, size)
        space = inner == np.repeat(size - 1, size)
        source = np.where(space, 0, inner + np.repeat(self.name_ends[ids], size))
        out = np.where(space, np.uint8(0x20), self.name_bytes[source])
        edges = np.append(at, total)[bounds]
        full = np.diff(edges) > 0
        keep = np.ones(total, bool)
        keep[edges[1:][full] - 1] = False
        return out[keep], edges - np.concatenate(([0], np.cumsum(full)))


@lru_cache(maxsize=4)
def model(path: str) -> Bpe:
    return Bpe(path)


class Transducer:
    """A minimal acyclic automaton over bytes whose arcs add up to a word's number; ids are listed by number.

    Equal suffixes share states. All tables are one flat file of unsigned 32-bit integers that is mapped,
    not read: sorted arcs (state and byte), their targets, the sums they add, final states, ends of the id lists, ids.
    """

    def __init__(self, path: str):
        flat = np.memmap(path, dtype=np.uint32, mode="r")
        sizes = flat[:6].astype(np.int64)
        ends = 6 + np.cumsum(sizes)
        self.arcs, self.targets, self.sums, self.final, self.ends, self.ids = (flat[e - n : e] for e, n in zip(ends, sizes, strict=True))

    @staticmethod
    def build(entries: dict[bytes, list[int]], path: str) -> None:
        words = sorted(entries)
        register: dict[tuple, int] = {}
        states: list[tuple] = []
        counts: list[int] = []
        open_: list[list] = [[False, []]]  # final, arcs (byte, state) of the word being read

        def close(down_to: int) -> None:
            while len(open_) > down_to:
                final, arcs = open_.pop()
                key = (final, tuple(arcs))
                if key not in register:
                    register[key] = len(states)
                    states.append(key)
                    counts.append(int(final) + sum(counts[s] for _, s in arcs))
                if open_:
                    open_[-1][1][-1] = (open_[-1][1][-1][0], register[key])

        before = b""
        for word in words:
            same = len(os.path.commonprefix([before, word]))
            close(same + 1)
            for b in word[same:]:
                open_[-1][1].append((b, -1))
                open_.append([False, []])
            open_[-1][0] = True
            before = word
        close(0)
        number = np.arange(len(states))[::-1]  # the first state is the root
        arcs, targets, sums = [], [], []
        for s, (final, own) in enumerate(states):
            before_ = int(final)
            for b, t in own:
                arcs.append(int(number[s]) << 8 | b)
                targets.append(int(number[t]))
                sums.append(before_)
                before_ += counts[t]
        order = np.argsort(np.array(arcs, np.int64), kind="stable")
        final_ = np.zeros(len(states), np.uint32)
        for s, (f, _) in enumerate(states):
            final_[number[s]] = f
        lists = [entries[w] for w in words]
        tables = [np.array(arcs, np.uint32)[order], np.array(targets, np.uint32)[order], np.array(sums, np.uint32)[order], final_, np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.uint32), np.array([i for x in lists for i in x], np.uint32)]
        np.concatenate([np.array([len(t) for t in tables], np.uint32), *tables]).tofile(path)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it isn't in the lexicon; all words step together."""
        out = np.full(len(words), -1, np.int64)
        if not words or not len(self.arcs):
            return out
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        live = np.arange(len(words))
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(live):
            done = lengths[live] == step
            ended = live[done]
            out[ended] = np.where(self.final[state[ended]] > 0, total[ended], -1)
            live = live[~done]
            arc = (state[live] << 8) | data[starts[live] + step]
            at = np.minimum(np.searchsorted(self.arcs, arc.astype(np.uint32)), len(self.arcs) - 1)
            found = self.arcs[at] == arc
            live, at = live[found], at[found]
            total[live] += self.sums[at]
            state[live] = self.targets[at]
            step += 1
        return out


class Encoder:
    """Ids of texts: each distinct pre-token is looked up in the lexicon once, or merged exactly once."""

    def __init__(self, path: str, lexicon: str | None = None, most: int = 400_000):
        self.bpe, self.most = model(path), most
        self.lexicon = Transducer(lexicon) if lexicon else None
        self._clear()

    def _clear(self) -> None:
        self.index: defaultdict[str, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.known, self.ends, self.ids = 0, np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _learn(self) -> None:
        new = list(self.index)[self.known :]
        if not new:
            return
        known = self.lexicon.lookup([w.encode("utf-8", "surrogatepass") for w in new]) if self.lexicon else np.full(len(new), -1)
        listed, other = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        sizes = np.zeros(len(new), np.int64)
        if len(listed):
            begin = self.lexicon.ends[known[listed]].astype(np.int64)
            sizes[listed] = self.lexicon.ends[known[listed] + 1] - begin
        sizes[other], merged = self.bpe.merge_many([new[i] for i in other.tolist()])
        ends = np.cumsum(sizes)
        ids = np.empty(int(sizes.sum()), np.int32)
        from_list = np.zeros(len(new), bool)
        from_list[listed] = True
        which = np.repeat(from_list, sizes)
        ids[~which] = merged
        if len(listed):
            size = sizes[listed]
            ids[which] = self.lexicon.ids[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - begin, size)]
        self.known = len(self.index)
        self.ids = np.concatenate((self.ids, ids))
        self.ends = np.concatenate((self.ends, self.ends[-1] + ends))

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and where each text's begin."""
        if len(self.index) > self.most:
            self._clear()
        codes: list[int] = []
        bounds, number, pieces = [0], self.index.__getitem__, self.bpe.pieces
        for t in texts:
            if t:
                codes += map(number, pieces(t))
            bounds.append(len(codes))
        self._learn()
        code = np.array(codes, np.int64)
        size = np.diff(self.ends)[code] if len(code) else code
        at = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.arange(at[-1]) - np.repeat(at[:-1] - self.ends[code], size)] if len(code) else self.ids[:0]
        return ids, at[np.array(bounds)]


def frequent_words(docs: DataFrame, most: int, longest: int = 64) -> DataFrame:
    """(piece, n) of the most frequent runs of letters of at most ``longest`` bytes, ``most`` at most, counted over every text. Longer words are merged where they occur.

    Case is folded by Spark's own rule here: which words are listed affects speed, never ids.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("piece")).where((F.col("piece") != "") & (F.octet_length("piece") <= longest))
    return C.most_frequent(words.groupBy("piece").agg(F.count("*").alias("n")), most, "words")


def publish_lexicon(docs: DataFrame, path: str, most: int) -> str | None:
    """Compiles the frequent words (at most ``most``) and ships the file to every executor; its name."""
    bpe = model(path)
    entries = {p.encode(): bpe.merge(p) for r in frequent_words(docs, most).collect() for p in bpe.pieces(r.piece)}
    if not entries:
        return None
    folder = os.path.realpath(tempfile.mkdtemp(prefix="lexicon-"))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    Transducer.build(entries, os.path.join(folder, name))
    docs.sparkSession.sparkContext.addFile(os.path.join(folder, name))
    return name


def encode_and_decode(docs: DataFrame, path: str, lexicon_words: int = 30_000) -> DataFrame:
    """Encodes every whole text and decodes the ids again: doc_id, ids, decoded (UTF-8 bytes).

    The most frequent ``lexicon_words`` words of all texts (that number and 64 bytes a word bound what the driver holds and ships)
    go into a memory-mapped transducer with their ids; other pre-tokens are merged exactly, once per task.
    Ids equal the public library's with ``add_special_tokens=False``: added tokens' strings in a text become
    their ids, every other character is encoded. ``decoded`` is what the library's ``decode`` with
    ``skip_special_tokens=False`` gives for a file without a decoder: token names joined by spaces.
    Null and empty texts: no ids; null and repeated doc_ids pass through; row order doesn't matter.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    name = publish_lexicon(docs, path, lexicon_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, SparkFiles.get(name) if name else None)
        for batch in batches:
            for part in slices(batch, 1):
                ids, bounds = encoder.encode(part.column(1).to_pylist())
                data, edges = encoder.bpe.decode(ids, bounds)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())), C.bytes_column(data, edges)], ["doc_id", "ids", "decoded"])

    return docs.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least."""
    _, offsets = C.text_buffer(batch.column(column))
    part = offsets[:-1] // most
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])) if len(part) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield batch.slice(a, b - a)


def op2(spark, sf_dir: str) -> DataFrame:
    out = encode_and_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path("word_bpe_49k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
