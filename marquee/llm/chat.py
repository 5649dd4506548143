"""Chat formatting: conversations rendered with turn marks, encoded once, with a loss mask aligned by token offsets."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.bpe import Encoder, default_path, model, slices

#: The template is, for each turn, mark, role, mark, text. The mark is a token of its own in the tokenizer's file, so
#: no token ever reaches over the edge of a text.
MARK = "<|endoftext|>"
FORMATTED = "conv_id long, part long, whole boolean, text string, ids array<int>, loss array<boolean>"


def escape(text: str) -> str:
    """Without any mark: a backslash before each backslash and inside each ``<|``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from a formatted conversation."""
    parts = formatted.split(MARK)[1:]
    return [(unescape(r), unescape(t)) for r, t in zip(parts[::2], parts[1::2], strict=True)]


def token_bytes(path: str) -> np.ndarray:
    """How many bytes of text each id stands for: a name has a letter for each byte."""
    return np.array([len(x.decode()) for x in model(path).names], np.int64)


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the spans."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps)[:-1] > 0


def token_mask(token_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens overlap one of the sorted spans; each span finds its first and last token by binary search."""
    token_starts = np.concatenate(([0], token_ends))[:-1]
    some = ends > starts
    first = np.searchsorted(token_ends, starts[some], side="right")
    last = np.searchsorted(token_starts, ends[some], side="left")
    return covered(first, last, len(token_ends))


def format_conversations(turns: DataFrame, path: str, learned: str = "assistant", part_bytes: int = 1 << 20, range_bytes: int = 4 << 20) -> DataFrame:
    """Formatted conversations with ids and the loss mask of each id: conv_id, part, whole, text, ids, loss.

    Turns go by turn; ties by role, then by a hash of the text, then by the text. Rows are dealt by ranges of that order, so
    even one conversation of very many turns spreads over tasks. A conversation is one row (``whole``), but where
    it is longer than ``part_bytes`` or reaches over the edge of a range: then it is several, in the order of
    ``part``, each of whole turns; as every turn begins with a token of its own, their ids end to end are those of
    the whole. Each part is encoded once; its token offsets are the sums of what its ids stand for. Tokens that
    overlap a text of the role ``learned`` are under the mask; no such token holds anything else.
    Null roles and texts count as empty; null turns come first; rows of null conv_id are one conversation;
    repeated rows are turns like any other.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text")).withColumn("tie", F.xxhash64("text"))
    ranges = C.partitions(max(1, -(-C.text_bytes(turns) // range_bytes)))
    order = ("conv_id", "turn", "role", "tie")
    turns = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "text").select("conv_id", "role", "text")

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bool, list[tuple[str, str]]]]:
        """(conv_id, whole, turns): a range's first and last conversation may go on in other ranges."""
        held, size, conv, begun = [], 0, None, False
        for batch in batches:
            for part in slices(batch, 2, part_bytes):
                for i, r, t in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    if held and (i != conv or size >= part_bytes):
                        yield conv, begun and i != conv, held
                        held, size, begun = [], 0, i != conv
                    conv = i
                    held.append((r, t))
                    size += len(t) + len(r)
        if held:
            yield conv, False, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = Encoder(path), token_bytes(path)
        if MARK not in encoder.bpe.added or encoder.bpe.folds:
            raise ValueError(f"{path}: no file of byte-level tokens with the mark {MARK}")
        number = TaskContext.get().partitionId() << 33

        def encode(parts: list) -> pa.RecordBatch:
            nonlocal number
            texts, starts, ends, at, mark = [], [], [], 0, len(MARK)
            for _, _, held in parts:
                out = []
                for r, t in held:
                    r_, t_ = escape(r), escape(t)
                    begin = at + 2 * mark + len(r_.encode())
                    at = begin + len(t_.encode())
                    if r == learned:
                        starts.append(begin)
                        ends.append(at)
                    out += (MARK, r_, MARK, t_)
                texts.append("".join(out))
            ids, bounds = encoder.encode(texts)
            loss = token_mask(np.cumsum(width[ids]), np.array(starts, np.int64), np.array(ends, np.int64))
            numbers = pa.array(np.arange(number, number + len(parts)))
            number += len(parts)
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)) for x in (ids, loss)]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int64()), numbers, pa.array([p[1] for p in parts]), pa.array(texts), *lists], [f.split()[0] for f in FORMATTED.split(", ")])

        group, size = [], 0
        for part in parts_of(batches):
            group.append(part)
            size += sum(len(t) for _, t in part[2])
            if size >= part_bytes:
                yield encode(group)
                group, size = [], 0
        if group:
            yield encode(group)

    return turns.mapInArrow(run, FORMATTED)


def digests(formatted: DataFrame, path: str) -> DataFrame:
    """What reads back from formatted conversations: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns are read from the text; the learned text is that of the tokens under the mask. A whole conversation
    is hashed where it lies. Parts of others meet in order, and run through two hashes part by part, as a hash of a whole needs.
    """
    names = ["conv_id", "part", "n_turns", "loss_chars", "formatted_chars", "turns_sha256", "loss_sha256", "turns", "learned"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = token_bytes(path)
        for batch in batches:
            for rows in slices(batch, 3):
                ids, loss = (rows.column(c).flatten() for c in (4, 5))
                token_ends = np.cumsum(width[ids.to_numpy()])
                token_starts = token_ends - width[ids.to_numpy()]
                under = loss.to_numpy(zero_copy_only=False)
                data, offsets = C.text_buffer(rows.column(3))
                kept = covered(token_starts[under], token_ends[under], len(data))
                out = []
                for d, (i, part, whole, text) in enumerate(zip(*(rows.column(c).to_pylist() for c in range(4)), strict=True)):
                    span = slice(offsets[d], offsets[d + 1])
                    learned = unescape(data[span][kept[span]].tobytes().decode())
                    found = turns_of(text)
                    whole_text, learned_bytes = "".join(f"{r}\n{t}\n" for r, t in found).encode(), learned.encode()
                    ends = (*(hashlib.sha256(x).hexdigest() for x in (whole_text, learned_bytes)), None, None) if whole else (None, None, whole_text, learned_bytes)
                    out.append((i, part, len(found), len(learned), len(text), *ends))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), [*[pa.int64()] * 5, *[pa.string()] * 2, *[pa.binary()] * 2], strict=True)], names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> tuple:
            return (conv, sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2])

        conv, sums, hashes = None, None, None
        for batch in batches:
            out = []
            for i, _, n, chars, size, a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if hashes and (a or i != conv):
                    out.append(close())
                    hashes = None
                if a:
                    out.append((i, n, a, chars, b, size))
                    continue
                if not hashes:
                    conv, sums, hashes = i, [0, 0, 0], (hashlib.sha256(), hashlib.sha256())
                sums = [s + v for s, v in zip(sums, (n, chars, size), strict=True)]
                hashes[0].update(x)
                hashes[1].update(y)
            if out:
                yield result(out)
        if hashes:
            yield result([close()])

    def result(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    rows = formatted.mapInArrow(read, "conv_id long, part long, n_turns long, loss_chars long, formatted_chars long, turns_sha256 string, loss_sha256 string, turns binary, learned binary")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return rows.mapInArrow(join, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op11(spark, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    path = default_path("byte_bpe_50k.json")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(turns.unionByName(own), path), path)
