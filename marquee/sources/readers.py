"""Readers of landed provider files. Every read is typed; what doesn't fit the schema comes back as a reason, not a crash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.functions import shapes as sh
from marquee.plans import fixed

EDGE = "struct<target:string,relationship:string,target_url:string,supporting_urls:array<string>>"
ENTITY = f"entity_id string, domain string, canonical_source string, source_role string, record_source string, title string, original_title string, media_type string, status string, release_year int, episodes int, synonyms array<string>, sources array<string>, genres array<string>, studios array<string>, creators array<string>, tags array<string>, related array<{EDGE}>, field_sources map<string,array<string>>"


TEXTS = sh.many(sh.string())
EDGE_SHAPE = sh.record({"target": sh.string(True), "relationship": sh.string(True), "target_url": sh.string(True), "supporting_urls": TEXTS}, closed=True)
ENTITY_SHAPE = sh.record(
    {n: sh.string(True) for n in ("entity_id", "domain", "canonical_source", "record_source", "title", "media_type", "status")}
    | {"source_role": sh.string(True, values=fixed.SOURCE_ROLES), "release_year": sh.whole(True), "episodes": sh.whole(nullable=True), "original_title": sh.string(nullable=True)}
    | {n: TEXTS for n in ("synonyms", "sources", "genres", "studios", "creators", "tags")}
    | {"related": sh.many(EDGE_SHAPE), "field_sources": sh.mapping(TEXTS)},
    closed=True,
)


def read_entities(spark: SparkSession, *paths: str) -> tuple[DataFrame, DataFrame]:
    """Entities of JSONL corpora, and the lines that are none: (value, reason, detail).

    Reasons, the first that holds: not_an_object (also for a key given twice), unknown_key, missing_required_field and wrong_type;
    detail names the fields at fault, nested ones by path. Absent lists are empty. Blank lines are skipped.
    """
    lines = spark.read.text(list(paths)).where(F.trim("value") != "")
    v = F.try_parse_json("value")
    steps = [("unknown_key", sh.UNKNOWN), ("missing_required_field", sh.MISSING), ("wrong_type", sh.WRONG)]

    def judged(found):
        case = F.when(found.isNull(), F.struct(F.lit("not_an_object").alias("reason"), F.lit("").alias("detail")))
        for reason, fault in steps:
            case = case.when(F.size(sh.of_kind(found, fault)) > 0, F.struct(F.lit(reason).alias("reason"), F.array_join(sh.of_kind(found, fault), ",").alias("detail")))
        return case

    marked = lines.withColumn("_r", sh.bound(v, lambda x: sh.bound(F.when(F.schema_of_variant(x).startswith("OBJECT"), sh.faults(x, ENTITY_SHAPE)), judged)))
    good = marked.where("_r is null").select(F.from_json("value", ENTITY).alias("e"), v.alias("v"))
    number = lambda c: F.try_variant_get("v", f"$.{c}", "int").alias(c)
    empty = {"related": f"array<{EDGE}>"} | {n: "array<string>" for n in ("synonyms", "sources", "genres", "studios", "creators", "tags")}
    column = lambda c: number(c) if c in ("release_year", "episodes") else F.coalesce(f"e.{c}", F.array().cast(empty[c])).alias(c) if c in empty else F.col(f"e.{c}")
    return good.select(*[column(f.split(" ")[0]) for f in _fields(ENTITY)]), marked.where("_r is not null").select("value", "_r.reason", "_r.detail")


def _fields(ddl: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(ddl[at:i].strip())
            at = i + 1
    return [*out, ddl[at:].strip()]


def flat_edges(ents: DataFrame) -> DataFrame:
    e = ents.select(F.col("entity_id").alias("source_entity_id"), F.posexplode("related").alias("pos", "edge"))
    return e.select("source_entity_id", "pos", F.col("edge.target").alias("target_entity_id"), "edge.relationship", "edge.target_url", "edge.supporting_urls")


def read_release(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """(repository, lastUpdate, pos, raw, and typed fields) of release documents, a file each. One document is one task, so rows are dealt out right after."""
    raw = spark.read.schema("repository string, lastUpdate string, data array<string>").option("multiLine", True).json(path)
    rows = raw.select("repository", "lastUpdate", F.posexplode("data").alias("pos", "raw")).repartition(partitions or spark.sparkContext.defaultParallelism)
    schema = "sources array<string>, title string, type string, episodes int, status string, animeSeason struct<season:string,year:int>, synonyms array<string>, relatedAnime array<string>, tags array<string>"
    return rows.withColumn("c", F.from_json("raw", schema)).select("repository", "lastUpdate", "pos", "raw", "c.*", F.col("c.animeSeason.year").alias("year"), F.col("c.relatedAnime").alias("related"))


def read_show_payloads(spark: SparkSession, path: str) -> DataFrame:
    schema = "id int, url string, name string, type string, language string, genres array<string>, status string, premiered string, officialSite string, network struct<name:string>, webChannel struct<name:string>, externals struct<imdb:string,thetvdb:int>, _embedded struct<episodes:array<struct<id:int>>>"
    s = spark.read.schema(schema).json(path)
    return s.select("id", "url", "name", "type", "language", X.sorted_distinct(F.filter("genres", lambda g: F.trim(g) != "")).alias("genres"), "status", "premiered", F.col("officialSite").alias("official_site"), F.col("externals.imdb").alias("imdb"), F.col("externals.thetvdb").alias("tvdb"), F.col("network.name").alias("network"), F.col("webChannel.name").alias("web_channel"), F.size(F.coalesce("_embedded.episodes", F.array().cast("array<struct<id:int>>"))).alias("episodes"))


def read_sparql_bindings(spark: SparkSession, path: str) -> DataFrame:
    """Movie records of SPARQL results: the last part of the item's URL is the qid and the label where there is none."""
    b = spark.read.schema("results struct<bindings:array<map<string,struct<value:string>>>>").option("multiLine", True).json(path).select(F.explode("results.bindings").alias("b"))
    value = lambda k: F.try_element_at("b", F.lit(k))["value"]
    many = lambda k: X.sorted_distinct(F.filter(F.split(F.coalesce(value(k), F.lit("")), r"\|"), lambda v: F.trim(v) != ""))
    qid = F.substring_index(value("item"), "/", -1)
    return b.select(qid.alias("qid"), F.coalesce(F.nullif(value("itemLabel"), F.lit("")), qid).alias("label"), many("aliases").alias("aliases"), value("publicationDate").alias("publication_date"), value("runtime").try_cast("double").cast("int").alias("runtime_minutes"), value("imdbId").alias("imdb_id"), many("genres").alias("genres"), many("directors").alias("directors"), many("series").alias("series"))


def read_catalog(spark: SparkSession, entities_path: str, edges_path: str) -> tuple[DataFrame, DataFrame]:
    """Entities and edges of a written corpus pair; either name of the type column; edges without a source row are dropped."""
    ents, edges = spark.read.parquet(entities_path), spark.read.parquet(edges_path)
    names = [c for c in ("relationship_type", "relationship") if c in edges.columns]
    edges = edges.withColumn("relationship", F.coalesce(*names))
    return ents, edges.join(ents.select(F.col("entity_id").alias("source_entity_id")), "source_entity_id", "left_semi")


def read_audit(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    """Audit rows of JSONL files; per source_id the last row counts: of the last path given, of its last file by name, there the last line."""
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).fieldNames()
    every = None
    for i, p in enumerate(paths):
        # Rows of a file come by block, and in their order inside one; task numbers need not follow the files.
        at = F.struct(F.lit(i).alias("path"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
        part = spark.read.schema(schema).json(p).select(F.struct(*names).alias("r"), at.alias("_at"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy("r.source_id").agg(F.max_by("r", "_at").alias("r")).select("r.*")
