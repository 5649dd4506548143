"""URL filtering: host and path rules, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import common as C
from marquee.llm.bpe import slices
from marquee.llm.labelled_urls import LABELLED

#: The rules (verdict, host, path).
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]

#: The least score of a block: nine tenths of the unwanted urls of unseen hosts reach it.
THRESHOLD = 0.43

#: Frames that stand round the names of learned hosts, so that neither they nor the languages of paths tell the labels apart.
BEFORE = ["", "www.", "m.", "blog.", "shop.", "en."]
ENDINGS = ["com", "net", "org", "info", "co.uk", "de", "sites.com", "pages.net"]
PATHS = ["/", "", "/en/123.html", "/de/77/", "/fr/2020/05/", "/index.php", "/es/thema"]
#: Parts of hosts that stand before or after the name.
_SECOND = {"co", "ac", "gov", "nlm", "nih"}


def labelled_urls() -> list[tuple[str, str, int]]:
    """The labelled table: (host, path, label 1: unwanted)."""
    out = []
    for line in filter(None, LABELLED):
        label, url = line.split(" ", 1)
        host, path = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url).groups()
        out.append((host.lower(), path, int(label)))
    return out


def host_name(host: str) -> str:
    """A host without its ending, and without a common first part."""
    parts = host.split(".")[:-1] or [host]
    while len(parts) > 1 and parts[-1] in _SECOND:
        parts.pop()
    return ".".join(parts[1:] if len(parts) > 1 and parts[0] + "." in BEFORE else parts)


def framed(rows: list[tuple[str, str, int]], each: int = 8) -> list[tuple[str, str, int]]:
    """Each url as it is, and ``each`` times with its host's name in other frames, half of them with a plain path."""
    out = []
    for i, (host, path, label) in enumerate(rows):
        out.append((host, path, label))
        for j in range(each):
            k = 7 * i + 11 * j
            out.append((f"{BEFORE[k % len(BEFORE)]}{host_name(host)}.{ENDINGS[(k // 2 + j) % len(ENDINGS)]}", path if j % 2 else PATHS[(i + j) % len(PATHS)], label))
    return out


def unseen_hosts(rows: list[tuple[str, str, int]], folds: int = 10) -> np.ndarray:
    """The score of each labelled url from a model that has seen no url of its host's last two parts (cross-validation)."""
    fold = np.array([zlib.crc32(".".join(h.split(".")[-2:]).encode()) % folds for h, *_ in rows])
    z = np.zeros(len(rows))
    for f in range(folds):
        own = [r for r, k in zip(rows, fold, strict=True) if k == f]
        z[fold == f] = train([r for r, k in zip(rows, fold, strict=True) if k != f]).scores(*url_buffer([h for h, *_ in own], [p for _, p, _ in own]))
    return z


def url_buffer(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Host and path of each url as learned: a dot at both ends of the host marks the bounds of its names; no host holds the byte between."""
    return C.text_buffer(pa.array([f".{h}.\n{p}" for h, p in zip(hosts, paths, strict=True)], pa.string()))


def gram_slots(data: np.ndarray, offsets: np.ndarray, slots: int, sizes: tuple[int, ...] = (3, 4, 5)) -> tuple[np.ndarray, np.ndarray]:
    """Hashed slots of all n-grams inside each text, and the text of each."""
    found, owners = [], []
    values = C.BYTE_VALUES[data]
    for n in sizes:
        if len(data) < n:
            continue
        at = np.arange(len(data) - n + 1)
        owner = np.searchsorted(offsets, at, side="right") - 1
        keep = at + n <= offsets[owner + 1]
        h = np.full(int(keep.sum()), n, np.uint64)
        for i in range(n):
            h = h * C.MULTIPLIER + values[at[keep] + i]
        found.append((C.mix(h) % np.uint64(slots)).astype(np.int64))
        owners.append(owner[keep])
    return (np.concatenate(found), np.concatenate(owners)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        slot, owner = gram_slots(data, offsets, len(self.weights))
        count = np.bincount(owner, minlength=n)
        z = self.bias + np.bincount(owner, weights=self.weights[slot], minlength=n) / np.sqrt(np.maximum(count, 1))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[str, str, int]], slots: int = 1 << 16, rounds: int = 300, rate: float = 2.0, decay: float = 1e-4) -> UrlModel:
    """Full-batch logistic regression on the n-grams of host and path of the labelled urls in their frames."""
    rows = framed(rows)
    data, offsets = url_buffer([h for h, *_ in rows], [p for _, p, _ in rows])
    y = np.array([label for *_, label in rows], float)
    slot, owner = gram_slots(data, offsets, slots)
    value = (1 / np.sqrt(np.maximum(np.bincount(owner, minlength=len(rows)), 1)))[owner]
    used, column = np.unique(slot, return_inverse=True)
    w, b = np.zeros(len(used)), 0.0
    for _ in range(rounds):
        z = np.bincount(owner, weights=w[column] * value, minlength=len(y)) + b
        error = (1 / (1 + np.exp(-z)) - y) / len(y)
        w -= rate * 10 * (np.bincount(column, weights=error[owner] * value, minlength=len(used)) + decay * w / 10)
        b -= rate * error.sum()
    weights = np.zeros(slots)
    weights[used] = w
    return UrlModel(weights, b)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; empty for a null url or one without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(url, pattern, 1), upper, upper.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def rule_choice(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. Rules are few: a stated list, not a table."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    when = lambda r: ((host == r[1]) | host.endswith("." + r[1])) & path.startswith(r[2])
    choices = [F.when(when(r), F.struct(F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("verdict"))) for r in ordered]
    return reduce(lambda a, b: F.coalesce(a, b), choices) if choices else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, labelled: list[tuple[str, str, int]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, score, verdict of every page's url.

    The longest rule that fits decides; otherwise the score does: ``block`` from ``threshold`` on. The model
    is trained here, on the small labelled table. Null urls and urls without ``://`` have empty host and path
    and a score like any other; urls of any length are read whole. Null and repeated page_ids pass through, one row
    each; other columns are not read.
    """
    model = train(labelled or labelled_urls())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                value = model.scores(*url_buffer(part.column(1).to_pylist(), part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value)], [*part.schema.names, "score"])

    host, path = url_parts(F.col("url").cast("string"))
    parts = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    scored = parts.mapInArrow(score, "page_id long, host string, path string, score double")
    choice = rule_choice(F.col("host"), F.col("path"), rules)
    return scored.withColumn("choice", choice).select("page_id", "host", "path", F.col("choice.rule").alias("rule"), "score", F.coalesce("choice.verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"))


def op9(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
