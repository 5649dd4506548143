"""Toxicity scores by a small convolutional text classifier over hashed word embeddings."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.bpe import slices

#: ASCII bytes that aren't letters or digits separate the classifier's words.
BREAKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: A word's embedding is the sum of hashed vectors: of the whole word and of its first bytes.
PREFIXES = (4, 5, 6)
SLOTS = 1 << 20
#: A slot starts from its lift in toxic texts as far as its log-likelihood ratio lies from LOW to HIGH; slots of fewer than COMMON texts aren't used.
LOW, HIGH, COMMON = 10, 30, 4


def _slots(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    spans = [ends] + [np.minimum(ends, starts + p) for p in PREFIXES]
    seeds = np.arange(1, len(spans) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return np.stack([(C.mix(C.hash_spans(data, starts, e) ^ s) % np.uint64(SLOTS)).astype(np.int32) for e, s in zip(spans, seeds, strict=True)], axis=1)


def _words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = C.text_buffer(column)
    data = C.lower_ascii(data)
    return data, *C.find_words(data, offsets, BREAKS)


def word_slots(column) -> tuple[np.ndarray, np.ndarray]:
    """Slots (words x features) of all texts end to end, and where each text's words begin."""
    data, starts, ends, bounds = _words(column)
    return _slots(data, starts, ends), bounds


def vocabulary(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts end to end, where each text's begin, and the slots of each different word (told apart by a 64-bit hash)."""
    number: dict[int, int] = {}
    words, sizes, tables = [], [], []
    for i in range(0, len(texts), 100):
        data, starts, ends, bounds = _words(pa.array(texts[i : i + 100], pa.string()))
        keys, first, inverse = np.unique(C.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        fresh = np.array([k not in number for k in keys.tolist()], bool)
        ids = np.array([number.setdefault(k, len(number)) for k in keys.tolist()], np.int32)
        tables.append(_slots(data, starts[first[fresh]], ends[first[fresh]]))
        words.append(ids[inverse.ravel()])
        sizes.append(np.diff(bounds))
    return np.concatenate(words), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), np.concatenate(tables)


@dataclass
class Network:
    """``used`` slots have trained vectors; every other slot is the zero vector."""

    used: np.ndarray
    vectors: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, size, filters)
    biases: list[np.ndarray]
    head: np.ndarray
    offset: float
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def embed(self, slots: np.ndarray) -> np.ndarray:
        if not len(self.used):
            return np.zeros((len(slots), self.vectors.shape[1]), np.float32)
        at = np.minimum(np.searchsorted(self.used, slots), len(self.used) - 1)
        at = np.where(self.used[at] == slots, at, len(self.used))
        table = np.concatenate((self.vectors, np.zeros((1, self.vectors.shape[1]), np.float32)))
        return table[at].sum(axis=1)

    def pooled(self, x: np.ndarray, bounds: np.ndarray, places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max over each text of every filter after rectification, and where the maxima are. Texts shorter than a width give 0."""
        n, out, where = len(bounds) - 1, [], []
        for w, b in zip(self.filters, self.biases, strict=True):
            width = w.shape[0]
            z = np.zeros((len(x), w.shape[2]), np.float32)
            for i in range(width):
                z[: len(x) - i] += x[i:] @ w[i]
            z += b
            z = np.maximum(z, 0)
            ends = np.maximum(bounds[1:] - width + 1, bounds[:-1])
            live = np.flatnonzero(ends > bounds[:-1])
            top = np.zeros((n, w.shape[2]), np.float32)
            if len(live):
                cuts = np.stack((bounds[:-1][live], ends[live]), axis=1).ravel()
                top[live] = np.maximum.reduceat(np.concatenate((z, np.zeros((1, z.shape[1]), np.float32))), cuts, axis=0)[::2]
            out.append(top)
            if places:
                at = np.full((n, w.shape[2]), -1)
                for d in live:
                    at[d] = bounds[d] + z[bounds[d] : ends[d]].argmax(axis=0)
                where.append(np.where(top > 0, at, -1))
        return np.concatenate(out, axis=1), where

    def logits(self, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.pooled(self.embed(slots), bounds)[0] @ self.head + self.offset + self.shift


def learn(texts: list[str | None], labels: np.ndarray, languages: list[str | None], least: float = 0.3, folds: int = 3, seed: int = 11) -> Network:
    """Trains the network in numpy on all texts, calibrated by cross-validation over all of them.

    Each fold's texts get their logits from a network trained on the others. The logits of the final network are
    shifted so that ``least`` is the threshold of best F1 over all texts, and a threshold is set per language (the overall one where a language has too few rows).
    """
    words, bounds, table = vocabulary(texts)
    fold = np.random.default_rng(seed).permutation(len(labels)) % folds
    z = np.zeros(len(labels))
    for f in range(folds):
        z[fold == f] = _logits_of(train(words, bounds, table, labels, np.flatnonzero(fold != f), seed=seed), words, bounds, table, np.flatnonzero(fold == f))
    net = train(words, bounds, table, labels, np.arange(len(labels)), seed=seed)
    cut = _best_cut(z, labels)
    net.shift = float(np.log(least / (1 - least))) - cut
    for lang in sorted({x for x in languages if x}):
        own = np.array([x == lang for x in languages])
        c = _best_cut(z[own], labels[own]) if labels[own].sum() >= 5 else cut
        net.thresholds[lang] = float(1 / (1 + np.exp(-(c + net.shift))))
    return net


def train(words: np.ndarray, bounds: np.ndarray, table: np.ndarray, labels: np.ndarray, kept: np.ndarray, size: int = 8, widths: tuple[int, ...] = (1, 2, 3), each: int = 8, rounds: int = 2, rate: float = 0.02, seed: int = 11) -> Network:
    """A network trained with Adam on the texts numbered ``kept``.

    The first component of a slot's vector starts from how much commoner the slot is in toxic texts, as far as the counts are
    evidence for it, so few labels suffice; the others start at small random values.
    """
    rng = np.random.default_rng(seed)
    own = [np.unique(words[bounds[d] : bounds[d + 1]]) for d in kept.tolist()]
    seen = np.unique(table[np.unique(np.concatenate(own))]) if own else table[:0].ravel()
    width = table.shape[1]
    local = np.minimum(np.searchsorted(seen, table), max(len(seen) - 1, 0)).astype(np.int32)
    known = seen[local] == table if len(seen) else np.zeros(table.shape, bool)
    toxic, clean = max(1, int(labels[kept].sum())), max(1, int((labels[kept] == 0).sum()))
    p, q = np.zeros(len(seen)), np.zeros(len(seen))
    for d, w in zip(kept.tolist(), own, strict=True):  # documents that hold a slot, by label
        (p if labels[d] else q)[np.unique(local[w])] += 1
    lift = np.log((p + 0.25) / (toxic + 0.5)) - np.log((q + 0.25) / (clean + 0.5))
    share = toxic / (toxic + clean)
    evidence = 2 * (p * np.log(np.maximum(p, 0.5) / ((p + q) * share)) + q * np.log(np.maximum(q, 0.5) / ((p + q) * (1 - share))))
    lift = np.clip(lift, -4, 4) * np.clip((evidence - LOW) / (HIGH - LOW), 0, 1)
    usable = p + q >= COMMON
    vectors = rng.normal(0, 0.01, (len(seen), size)).astype(np.float32)
    vectors[:, 0] = lift / width
    vectors[~usable] = 0
    known &= usable[local] if len(seen) else known
    filters = [rng.normal(0, 0.1, (k, size, each)).astype(np.float32) for k in widths]
    for w in filters:
        w[0, 0, : each // 2] = 0.5
    net = Network(seen, vectors, filters, [np.full(each, -0.1, np.float32) for _ in widths], rng.normal(0, 0.1, each * len(widths)).astype(np.float32), float(np.log(toxic / clean)))
    net.head[: each // 2] = 0.5
    if not len(seen) or labels[kept].min(initial=1) == labels[kept].max(initial=0):
        net.offset = -30.0  # nothing to learn from: no text is toxic
        return net
    params = [net.vectors, *net.filters, *net.biases, net.head]
    first, second = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
    moved, offset_m, offset_v, step = np.zeros(len(seen), np.int64), 0.0, 0.0, 0
    batch = 64

    def adam(k: int, at, grad: np.ndarray) -> None:
        first[k][at] = 0.9 * first[k][at] + 0.1 * grad
        second[k][at] = 0.99 * second[k][at] + 0.01 * grad * grad
        params[k][at] -= rate * (first[k][at] / (1 - 0.9**step)) / (np.sqrt(second[k][at] / (1 - 0.99**step)) + 1e-6)

    for _ in range(rounds):
        for docs in np.array_split(rng.permutation(kept), max(1, len(kept) // batch)):
            step += 1
            take = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            cuts = np.concatenate(([0], np.cumsum(bounds[docs + 1] - bounds[docs])))
            s, ok = local[words[take]], known[words[take]]
            x = (net.vectors[s] * ok[:, :, None]).sum(axis=1)
            pooled, where = net.pooled(x, cuts, places=True)
            z = pooled @ net.head + net.offset
            error = ((1 / (1 + np.exp(-z)) - labels[docs]) / len(docs)).astype(np.float32)
            back = error[:, None] * net.head
            grad_head = pooled.T @ error + 1e-5 * net.head
            touched, gx = [], []
            for i, (w, at) in enumerate(zip(net.filters, where, strict=True)):
                d, f = np.nonzero(at >= 0)
                g, place = back[d, i * each + f], at[d, f]
                gw, gb = np.zeros_like(w), np.bincount(f, weights=g, minlength=each).astype(np.float32)
                for j in range(w.shape[0]):
                    np.add.at(gw[j].T, f, g[:, None] * x[place + j])
                    touched.append(place + j)
                    gx.append(g[:, None] * w[j][:, f].T)
                adam(1 + i, slice(None), gw)
                adam(1 + len(widths) + i, slice(None), gb)
            place, grad = np.concatenate(touched), np.concatenate(gx)
            ids = s[place]
            good = ok[place]
            flat, inverse = np.unique(ids[good], return_inverse=True)
            gv = np.zeros((len(flat), size), np.float32)
            np.add.at(gv, inverse.ravel(), np.repeat(grad, width, axis=0)[good.ravel()])
            adam(0, flat, gv / width)
            moved[flat] += 1
            adam(len(params) - 1, slice(None), grad_head)
            g = float(error.sum())
            offset_m, offset_v = 0.9 * offset_m + 0.1 * g, 0.99 * offset_v + 0.01 * g * g
            net.offset -= rate * (offset_m / (1 - 0.9**step)) / (np.sqrt(offset_v / (1 - 0.99**step)) + 1e-6)

    useful = np.abs(net.vectors).max(axis=1) > 0.02
    net.used, net.vectors = net.used[useful], net.vectors[useful]
    if not len(net.used):
        net.used, net.vectors = seen[:1], vectors[:1] * 0
    return net


def _logits_of(net: Network, words: np.ndarray, bounds: np.ndarray, table: np.ndarray, docs: np.ndarray) -> np.ndarray:
    out = np.zeros(len(docs))
    for at in range(0, len(docs), 64):
        part = docs[at : at + 64]
        take = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in part])
        out[at : at + 64] = net.logits(table[words[take]], np.concatenate(([0], np.cumsum(bounds[part + 1] - bounds[part]))))
    return out


def _best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap whose threshold has the best F1; 0 without both labels."""
    if not y.any() or y.all():
        return 0.0
    order = np.argsort(-z)
    z, y = z[order], y[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(z) + 1) + y.sum())
    k = int(np.argmax(np.where(np.append(z[1:], -np.inf) < z, f1, -1)))
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k] - 1)


def labelled(docs: DataFrame, labels: DataFrame, most: int, most_bytes: int) -> DataFrame | None:
    """The sample: (doc_id, toxic, text, lang) of ids whose crc32 mod 4 is not 2; None without any.

    Each label gives its first ``most`` rows by id hash, whole texts of half of ``most_bytes`` in all: one that no longer fits is
    passed over and the next one tried. If none of a label fits, its shortest is taken, whole. The choice is made on
    sizes, so no other text reaches the driver. An id that repeats gives its shortest text.
    """
    labels = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = labels.where(~held_out(F.col("doc_id")))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), lang.alias("lang")).withColumn("size", F.octet_length("text"))
    sizes = docs.select("doc_id", "size").join(labels, "doc_id").groupBy("doc_id", "toxic").agg(F.coalesce(F.min("size"), F.lit(0)).alias("size"))
    chosen = []
    for toxic in (0, 1):
        own, left = sizes.where(F.col("toxic") == toxic), most_bytes // 2
        fitting = []
        for r in own.where(F.col("size") <= left).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect():
            if r.size <= left:
                left -= r.size
                fitting.append((r.doc_id, toxic, r.size))
        chosen += fitting or [(r.doc_id, toxic, r.size) for r in own.orderBy("size", "doc_id").limit(1).collect()]
    if not chosen:
        return None
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id long, toxic int, least int")
    rows = docs.join(F.broadcast(picked), "doc_id").where("size is null or size = least")
    return rows.groupBy("doc_id", "toxic").agg(F.max("text").alias("text"), F.max("lang").alias("lang"))


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, most: int = 4000, most_bytes: int = 16_000_000) -> Network | None:
    """The network, from at most ``most`` labelled rows of each label and ``most_bytes`` of text (the documented bound of the sample).

    One task trains it on the sample, so neither the driver's memory nor its time depends on the texts; a lost task trains the same again.
    """
    sample = labelled(docs, labels, most, most_bytes)
    if sample is None:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))
        if len({r[1] for r in rows}) > 1:
            network = learn([r[2] for r in rows], np.array([r[1] for r in rows]), [r[3] for r in rows])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(network)], pa.binary())], ["network"])
        del rows
        C.trim_memory()

    found = sample.select("doc_id", "toxic", "text", "lang").coalesce(1).mapInArrow(run, "network binary").first()
    return pickle.loads(found.network) if found else None


def _values(net: Network | None, column) -> np.ndarray:
    """A score for each text."""
    if net is None:
        return np.zeros(len(column))
    slots, bounds = word_slots(column)
    return 1 / (1 + np.exp(-np.clip(net.logits(slots, bounds).astype(np.float64), -30, 30)))


def score(docs: DataFrame, labels: DataFrame, most: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.3) and language_flag of every whole text.

    Labels, lang, source and doc_id never enter a score; lang only chooses the threshold of language_flag.
    held_out rows (crc32 of the id as text, mod 4, is 2) are never learned from. Null and empty texts get the
    score of a text without words; without texts of both labels to learn from every score is 0. Null ids are not held out; repeated
    ids give a row each, and a label that repeats counts once, toxic if any says so.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), lang.alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part in slices(batch, 1, 1 << 19):
                value = _values(net, part.column(1))
                least = np.array([net.thresholds.get(x, 0.3) for x in part.column(2).to_pylist()]) if net else 2.0
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(value), pa.array(value >= least)], ["doc_id", "score", "language_flag"])

    out = rows.mapInArrow(run, "doc_id long, score double, language_flag boolean")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "language_flag")


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = 4000, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score is under ``least``, unchanged: each row is judged by its own text alone. Without texts of both labels all rows stay.

    Nothing is shuffled, so null and repeated ids are rows like any other; ``docs`` has a string column text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, most))
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, 1 << 19):
                yield part.filter(pa.array(_values(shared.value, part.column(text)) < least))
        C.trim_memory()

    return docs.mapInArrow(run, docs.schema)


def op3(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
