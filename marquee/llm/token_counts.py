"""Token counts of whole texts from per-document pre-token frequencies, without building any id list."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.skew import crowded_keys, join_crowded
from marquee.llm import common as C
from marquee.llm.bpe import default_path, model, slices

#: A row for each slice of texts: its documents, the pieces it holds, and the (piece, frequency) pairs of each document.
TALLY = "uids array<long>, doc_ids array<long>, n_bytes array<long>, ends array<int>, codes binary, counts binary, pieces array<binary>"
#: Longer pieces are never broadcast.
LONGEST = 64


def tally(docs: DataFrame, path: str, slice_bytes: int = 2 << 20) -> DataFrame:
    """Splits every text of ``docs`` (uid, doc_id, text) into pieces, once; see TALLY."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for batch in batches:
            for part in slices(batch, 2, slice_bytes):
                index: defaultdict[str, int] = defaultdict()
                index.default_factory = index.__len__
                codes: list[int] = []
                bounds, number = [0], index.__getitem__
                for t in part.column(2).to_pylist():
                    if t:
                        codes += map(number, bpe.pieces(t))
                    bounds.append(len(codes))
                row = np.repeat(np.arange(part.num_rows), np.diff(bounds))
                pairs, f = np.unique(row << 32 | np.array(codes, np.int64), return_counts=True)
                ends = np.searchsorted(pairs, np.arange(1, part.num_rows + 1) << 32)
                names = [w.encode("utf-8", "surrogatepass") for w in index]
                whole = [part.column(0).to_pylist(), part.column(1).to_pylist(), np.diff(C.text_buffer(part.column(2))[1]).tolist(), ends.tolist(), (pairs & 0xFFFFFFFF).astype(np.uint32).tobytes(), f.astype(np.uint32).tobytes(), names]
                types = [*[pa.list_(pa.int64())] * 3, pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(whole, types, strict=True)], [c.split()[0] for c in TALLY.split(", ")])

    return docs.mapInArrow(count, TALLY)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            r = batch.slice(i, 1)
            yield r, *(np.frombuffer(r.column(c)[0].as_py(), np.uint32).astype(np.int64) for c in ("codes", "counts"))


def piece_sizes(pieces: DataFrame, path: str) -> DataFrame:
    """Adds n_tokens to rows of ``pieces`` (a binary column piece, others as they are): each distinct piece is merged once, where all its rows meet."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, before, known = model(path), None, 0
        for batch in batches:
            if batch.num_rows:
                code = batch.column("piece").dictionary_encode()
                names = code.dictionary.to_pylist()
                new = names[1:] if names[0] == before else names
                size = bpe.sizes([w.decode("utf-8", "surrogatepass") for w in new])
                size = np.concatenate(([known], size)) if len(new) < len(names) else size
                before, known = names[-1], size[-1]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size[code.indices.to_numpy()])], [*batch.schema.names, "n_tokens"])

    dealt = pieces.repartition("piece").sortWithinPartitions("piece")
    return dealt.mapInArrow(measure, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", n_tokens long")


def frequent_pieces(tallied: DataFrame, most: int) -> DataFrame:
    """(piece) of at most ``most`` frequent ones of at most LONGEST bytes, by their frequencies over all slices that hold them twice or more."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, codes, counts in _rows(batches):
            pieces = r.column("pieces")[0].values
            n = np.bincount(codes, weights=counts, minlength=len(pieces)).astype(np.int64)
            at = pa.array(np.flatnonzero((n > 1) & (np.diff(C.text_buffer(pieces)[1]) <= LONGEST)))
            yield pa.RecordBatch.from_arrays([pieces.take(at), pa.array(n).take(at)], ["piece", "n"])

    counts = tallied.select("codes", "counts", "pieces").mapInArrow(often, "piece binary, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return C.most_frequent(counts, most, "pieces").select("piece")


def count_tokens(docs: DataFrame, path: str, common: int = 200_000) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text, as the public library encodes it.

    Texts are split once, into piece frequencies by document. Each distinct pre-token is merged once, for its
    number of tokens alone, and joined to the frequencies: the ``common`` most frequent ones (that number and
    LONGEST bound what is broadcast) with their numbers where the documents are, rarer ones where they are dealt by
    the pre-token, longer ones by a join on their digest; the products are summed by document. Which are common only moves work between these ways.
    Null text counts as empty: 0 bytes, 0 tokens. Repeated and null doc_ids give one row each.
    """
    spark = docs.sparkSession
    docs = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tallied = C.materialize(tally(docs, path), "tally", packed=True)
    top = piece_sizes(frequent_pieces(tallied, common), path).collect()
    shared = spark.sparkContext.broadcast({bytes(r.piece): r.n_tokens for r in top})

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        names = ["uid", "doc_id", "n_bytes", "f", "piece"]
        for r, codes, counts in _rows(batches):
            pieces, uids, doc_ids, n_bytes = (r.column(c)[0].values for c in ("pieces", "uids", "doc_ids", "n_bytes"))
            ends = r.column("ends")[0].values.to_numpy()
            size = np.array([known(w, 0) for w in pieces.to_pylist()], np.int64)
            each = size[codes] if len(codes) else codes
            sums = np.diff(np.concatenate(([0], np.cumsum(counts * each)))[np.concatenate(([0], ends))])
            yield pa.RecordBatch.from_arrays([uids, doc_ids, n_bytes, pa.array(sums), pa.nulls(len(uids), pa.binary())], names)
            rare = np.flatnonzero(each == 0)
            for at in range(0, len(rare), 50_000):
                part = rare[at : at + 50_000]
                owner = pa.array(np.searchsorted(ends, part, side="right"))
                none = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([uids.take(owner), none, none, pa.array(counts[part]), pieces.take(pa.array(codes[part]))], names)

    rows = C.materialize(tallied.mapInArrow(split, "uid long, doc_id long, n_bytes long, f long, piece binary"), "pieces-of-documents")
    C.discard(spark, tallied)
    own = rows.where("piece is null").select("uid", "doc_id", "n_bytes", F.col("f").alias("n"))
    dealt = piece_sizes(rows.where(F.octet_length("piece") <= LONGEST).select("uid", "f", "piece"), path)
    # A long piece may be in any number of documents: each is merged once, and its rows meet its size by a digest, dealt where it is crowded.
    long = rows.where(F.octet_length("piece") > LONGEST)
    digest = F.sha2("piece", 256).alias("digest")
    sizes = piece_sizes(long.select("piece").distinct(), path).select(digest, "n_tokens")
    long = long.select("uid", "f", digest)
    met = join_crowded(long, sizes, "digest", "uid", crowded_keys(long, "digest"))
    none = F.lit(None).cast("long")
    product = lambda df: df.select("uid", none.alias("doc_id"), none.alias("n_bytes"), (F.col("f") * F.col("n_tokens")).alias("n"))
    parts = own.unionByName(product(dealt)).unionByName(product(met))
    return parts.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens")).drop("uid")


def op6(spark, sf_dir: str) -> DataFrame:
    out = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
