"""Chat formatting, fill-in-the-middle and resampling against plain versions: nulls, empty and long texts, ties, repeats, odd columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import bpe, chat, infilling, resampling

SPACE = "\x20\x09-\x0d"
UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
FEATURE_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TURNS = "conv_id long, turn long, role string, text string, part string, ids int, loss double"
DOCS = "doc_id long, text string, n string, form int, output int, score int, uid int, at int, place int, rank int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def made_up():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["é", "naïve", "Straße", "漢字", "x" * 90, "\U0001f600\U0001f468", " "]
    make = lambda n, gap=" ": gap.join(rng.choice(words) for _ in range(n))
    shared = make(400)
    texts = [None, "", " ", "\n\t ", "one", " one", "one ", "two words", "<P>", make(30) + " <M> x", "<" * 40, "P> S> <P <S", make(3000), make(50, "\n\n"), "b" * 9000, "ab " * 4000, " " * 3000 + "x", "a\x1cb c"]
    return texts + [make(rng.randrange(60)) + " " + shared + make(20) for _ in range(40)] + [make(rng.randrange(1, 40)) for _ in range(60)]


def rearranged(doc_id, text, seed=42):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    units = UNIT.findall(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return len(units), "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


@pytest.mark.parametrize("bits", [2, 9])
def test_fill_in_middle(spark, bits):
    texts = made_up()
    rows = [(k * 211 + i, t) for k in range(6) for i, t in enumerate(texts)] + [(None, "no id " * 9), (7, "again"), (7, "again")]
    got = infilling.fill_in_middle(spark.createDataFrame([(i, t, "n", 1, 2, 3, 4, 5, 6, 7) for i, t in rows], DOCS), bits=bits)
    got = got.withColumn("back", infilling.restored())
    found = Counter(tuple(r) for r in got.collect())
    assert found == Counter((i, *rearranged(i, t), t or "") for i, t in rows)
    assert {r[2] for r in found} == {"plain", "spm", "psm"}
    assert infilling.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_units_of_every_place():
    texts = [t or "" for t in made_up()[:18]] + ["", "é é", "漢字 漢字\n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    units = infilling.Units(data, offsets, infilling.ChunkSummaries(), bits=3)
    for d, t in enumerate(texts):
        ends = [0, *(m.end() for m in UNIT.finditer(t))]
        assert units.counts[d] == len(ends) - 1
        for m in range(0, len(ends), max(1, len(ends) // 200)):
            assert units.end(d, m) == (len(t[: ends[m]].encode()), ends[m])


def test_shared_chunks_are_read_once():
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(3000)).encode()
    texts = [str(i).encode() * 7 + passage for i in range(20)]
    cache = infilling.ChunkSummaries()
    infilling.Units(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))), cache, 9)
    assert len(passage) < cache.held < 2 * len(passage)
    cache = infilling.ChunkSummaries(most_bytes=1000)
    for t in texts:
        units = infilling.Units(np.frombuffer(t, np.uint8), np.array([0, len(t)]), cache, 9)
        assert units.counts[0] == 3000 and cache.held < len(passage) + 2000


def digest(turns):
    """n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of sorted (role, text)."""
    learned = "".join(t for r, t in turns if r == "assistant")
    size = sum(26 + sum(len(x) + x.count("\\") + x.count("<|") for x in (r, t)) for r, t in turns)
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), size


@pytest.mark.parametrize(("part_bytes", "range_bytes"), [(1 << 20, 4 << 20), (200, 3000)])
def test_chat(spark, part_bytes, range_bytes):
    rng = random.Random(9)
    odd = ["", None, " ", "\n", "\\", "<|endoftext|>", "\\<|", "<\\|", "<<||>", "\\### Assistant: </turn> ok", "漢字\U0001f600", "a" * 50_000, "x <|endoftext|> y", "don't"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], rng.choice(odd) if rng.random() < 0.5 else "hello there " * rng.randrange(1, 30)))
    rows += [(100, i, ("user", "assistant")[i % 2], f"turn {i} <| of many ") for i in range(4000)]  # one conversation holds most rows
    rows += [(101, 0, "assistant", "same")] * 3 + [(101, None, None, "first"), (102, 0, "assistant", None), (103, 0, "<|endoftext|>", "odd role"), (None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    frame = spark.createDataFrame([(*r, "p", 1, 0.5) for r in shuffled], TURNS)
    path = bpe.default_path("byte_bpe_50k.json")
    formatted = chat.format_conversations(frame, path, part_bytes=part_bytes, range_bytes=range_bytes)
    want = {}
    for i, _, r, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "")):
        want.setdefault(i, []).append((r or "", t or ""))
    got = chat.digests(formatted, path).collect()
    assert len(got) == len(want)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in got} == {i: digest(t) for i, t in want.items()}

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    parts = {}
    for r in sorted(formatted.collect(), key=lambda r: r.part):
        parts.setdefault(r.conv_id, []).append(r)
    if part_bytes < 1000:
        assert len(parts[100]) > 100 and len({r.part >> 33 for r in parts[100]}) > 4
    for i, found in parts.items():
        text, ids, loss = "".join(r.text for r in found), [x for r in found for x in r.ids], [x for r in found for x in r.loss]
        whole = library.encode(text, add_special_tokens=False)
        assert ids == whole.ids and chat.turns_of(text) == want[i]
        spans, at = [], 0
        for r, t in want[i]:
            begin = at + 26 + len(chat.escape(r))
            at = begin + len(chat.escape(t))
            spans += [(begin, at)] if r == "assistant" and at > begin else []
        k = 0
        for (a, b), under in zip(whole.offsets, loss, strict=True):
            while k < len(spans) and spans[k][1] <= a:
                k += 1
            assert under == (k < len(spans) and a < spans[k][1] and b > spans[k][0])


def test_chat_of_nothing(spark):
    path = bpe.default_path("byte_bpe_50k.json")
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], TURNS), path), path).collect() == []
    assert all(chat.unescape(chat.escape(t)) == t and chat.MARK not in chat.escape(t) for t in ("\\", "<|", "\\<|", "<\\|", "<|endoftext|>", "\\\\<<|||", ""))


def resampled(docs, target, percent, least, buckets=10_000):
    def features(t):
        w = FEATURE_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return w, w + [" ".join(p) for p in zip(w, w[1:], strict=False)]

    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])

    s, t = counts(t for _, t in docs), counts(target)
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        w, f = features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(w), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(out):
        out[k] = (*r, None)
    drawn = [(*r, k + 1) for k, r in enumerate(fit[: len(fit) * percent // 100])]
    left = Counter(out)
    left.subtract((*r[:5], None) for r in drawn)
    return +left + Counter(drawn)


@pytest.mark.parametrize(("percent", "least", "buckets"), [(25, 20, 10_000), (100, 0, 7), (37, 2, 3), (0, 20, 100), (25, 10**6, 100)])
def test_resampling(spark, percent, least, buckets):
    docs = list(enumerate([*made_up(), "A bÉ C-d_e 9", "y" * 200 + " z " + "y" * 100_000, "tail " * 25] * 2))
    docs += [(7, "equal id and text " * 6)] * 6 + [(None, "no id but words " * 7), (None, "no id but words " * 7)]
    random.Random(2).shuffle(docs)
    target = ["w1 w2 w3 w1 w2", None, "", "hello tail TAIL naïve"]
    frame = spark.createDataFrame([(i, t, "n", 1, 2, 3, 4, 5, 6, 7) for i, t in docs], DOCS).repartition(7)
    got = resampling.resample(frame, spark.createDataFrame([(0, t, 1) for t in target], "item_id long, text string, uid int"), percent, least, buckets)
    assert Counter(tuple(r) for r in got.collect()) == resampled(docs, target, percent, least, buckets)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, none).collect() == []


def test_tied_scores_are_cut_by_id(spark, monkeypatch):
    docs = [(i, "a b c") for i in range(4000)]
    random.Random(4).shuffle(docs)
    plain = resampling.scores
    monkeypatch.setattr(resampling, "scores", lambda *a: plain(*a).withColumn("score", F.lit(3).cast("long")))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r["rank"] for r in resampling.resample(frame, frame, 25, 2).collect()}
    assert got == {i: i + 1 if i < 1000 else None for i in range(4000)}


def test_checksums():
    rng = random.Random(1)
    words = [bytes(rng.randrange(97, 123) for _ in range(n)) for n in [*range(1, 140), 64, 65, 1000, 70_000]]
    rng.shuffle(words)
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    one = resampling.checksums(data, starts, ends)
    assert one.tolist() == [zlib.crc32(w) for w in words]
    two = resampling.joined_checksums(one[:-1], one[1:], (ends - starts)[1:])
    assert two.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(words, words[1:], strict=False)]
    bucket, begin, number = resampling.features(pa.array(["B a b", None, "", "c"]), 1000)
    assert begin.tolist() == [0, 5, 5, 5, 6] and number.tolist() == [3, 0, 0, 1]
    assert bucket.tolist() == [zlib.crc32(x) % 1000 for x in (b"b", b"a", b"b", b"b a", b"a b", b"c")]
