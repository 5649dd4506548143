"""Writers of contract tables, corpus pairs, JSONL and snapshots. Counts come from the write itself."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.functions.rounds import hadoop_path
from marquee.plans import fixed


def write_tables(frames: dict[str, DataFrame], folder: str, version: str = "core.v1", tier: str = "core", enrichment: str = "none") -> DataFrame:
    """Each frame as zstd Parquet under its name; the manifest rows (one per table) with the rows that were written, versions and policy."""
    spark = next(iter(frames.values())).sparkSession
    rows = []
    for name, df in frames.items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")
        rows.append((name, f"{name}.parquet", "parquet", int(seen.get["n"]), version, tier, fixed.POLICY_VERSION, fixed.TABLE_RECIPE, enrichment))
    return spark.createDataFrame(rows, "table_name string, path string, format string, row_count long, schema_version string, compatibility_tier string, policy_version string, recipe_version string, enrichment_status string")


def write_corpus(entities: DataFrame, edges: DataFrame, folder: str) -> DataFrame:
    return write_tables({"entities": entities, "relationships": edges}, folder, version="corpus.v1", tier="experimental")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def pointers(spark: SparkSession, root: str, job: str) -> list[int]:
    """Numbers of the pointers of a job that were ever published, in order."""
    place, system = hadoop_path(spark, f"{root}/current/{job}")
    if not system.exists(place):
        return []
    names = [f.getPath().getName() for f in system.listStatus(place)]
    return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))


def publish(spark: SparkSession, root: str, job: str, pointer: dict) -> int:
    """Makes a snapshot the current one: a pointer file is written aside and renamed to the next number, which is one step. Readers follow the highest number."""
    number = (pointers(spark, root, job) or [0])[-1] + 1
    aside, system = hadoop_path(spark, f"{root}/current/{job}/.{uuid.uuid4().hex}")
    out = system.create(aside, True)
    out.write(bytearray(json.dumps(pointer, sort_keys=True).encode()))
    out.close()
    place, _ = hadoop_path(spark, f"{root}/current/{job}/{number:08d}.json")
    if system.exists(place) or not system.rename(aside, place):
        raise RuntimeError(f"{place.toString()} was published by another run")
    return number


def current(spark: SparkSession, root: str, job: str) -> tuple[str, dict[str, DataFrame]] | None:
    """The current snapshot's id and tables; None before the first is published."""
    numbers = pointers(spark, root, job)
    if not numbers:
        return None
    pointer = json.loads("".join(r.value for r in spark.read.text(f"{root}/current/{job}/{numbers[-1]:08d}.json").collect()))
    return pointer["snapshot"], {name: spark.read.parquet(f"{root}/{pointer['folder']}/{name}.parquet") for name in pointer["tables"]}


def materialize_snapshot(frames: dict[str, DataFrame], root: str, job: str, snapshot: str) -> DataFrame:
    """The bundle under snapshots/<job>/<snapshot>, and then a pointer to it under current/<job>: until that one step, and after a failure, readers
    see the snapshot before, whole. A snapshot that is current is never written again."""
    spark = next(iter(frames.values())).sparkSession
    folder = f"snapshots/{job}/{snapshot}"
    now = current(spark, root, job)
    if now and now[0] == snapshot:
        raise ValueError(f"{folder} is published")
    manifest = write_tables(frames, f"{root}/{folder}")
    publish(spark, root, job, {"snapshot": snapshot, "folder": folder, "tables": list(frames)})
    return manifest
