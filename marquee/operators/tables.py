"""Builders of the written tables: one frame of wide entities (and flat edges) in, one contract table out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import exprs as X
from marquee.functions.skew import join_streamed
from marquee.operators import edges as E
from marquee.plans import fixed


def source_id() -> Column:
    return X.policy_source_id(F.col("record_source"))


def evidence_id() -> Column:
    return X.stable_id(F.lit("evidence"), F.col("entity_id"))


def provenance_id() -> Column:
    return X.stable_id(F.lit("provenance"), source_id(), F.col("entity_id"))


def entities_table(ents: DataFrame) -> DataFrame:
    return ents.select(
        "entity_id", "domain", "media_type", "status", X.zero_to_null(F.col("release_year")).cast("long").alias("release_year"), F.lit(None).cast("date").alias("release_date"),
        F.lit("high").alias("confidence_tier"), F.greatest(F.lit(1), F.size("sources")).cast("long").alias("evidence_count"), F.lit("none").alias("conflict_status"),
        F.array(F.lit("source_backed")).alias("quality_flags"), evidence_id().alias("evidence_id"), provenance_id().alias("provenance_id"), F.lit(fixed.TABLE_RECIPE).alias("recipe_version"), F.lit("entities").alias("manifest_table_name"),
    )


def titles_table(ents: DataFrame) -> DataFrame:
    """Canonical, original and alias titles; distinct by (type, title) within an entity."""
    entry = lambda kind, title: F.struct(F.lit(kind).alias("title_type"), title.alias("title"))
    original = F.when((F.col("original_title") != "") & (F.col("original_title") != F.col("title")), entry("original", F.col("original_title")))
    aliases = F.transform(F.filter("synonyms", lambda s: s != F.col("title")), lambda s: entry("alias", s))
    every = F.array_distinct(F.concat(F.array_compact(F.array(entry("canonical", F.col("title")), original)), aliases))
    out = ents.withColumn("t", F.explode(every))
    return out.select(
        X.stable_id(F.lit("title"), F.col("entity_id"), F.col("t.title_type"), F.col("t.title")).alias("title_id"), "entity_id", F.col("t.title").alias("title"), F.col("t.title_type").alias("title_type"),
        F.lit(None).cast("string").alias("language"), F.lit(None).cast("string").alias("script"), source_id().alias("source_id"), evidence_id().alias("evidence_id"), provenance_id().alias("provenance_id"),
        F.when(F.col("t.title_type") == "canonical", "high").otherwise("medium").alias("confidence_tier"), F.array(F.lit("source_backed")).alias("quality_flags"), F.lit(fixed.TABLE_RECIPE).alias("recipe_version"),
    )


def external_ids_table(ents: DataFrame) -> DataFrame:
    return ents.select(
        X.stable_id(F.lit("external-id"), F.col("entity_id"), F.col("record_source")).alias("external_id_row_id"), "entity_id", source_id().alias("source_id"), "source_role",
        F.substring_index("entity_id", ":", -1).alias("external_id"), F.col("canonical_source").alias("url"), provenance_id().alias("provenance_id"), F.lit(fixed.TABLE_RECIPE).alias("recipe_version"),
    )


def relationship_key() -> Column:
    return X.stable_id(F.lit("relationship"), F.col("source_entity_id"), F.col("relationship"), F.col("target_entity_id"))


def relationships_table(edges: DataFrame, ents: DataFrame) -> DataFrame:
    """One row per edge of an entity in ``ents``; tier and flags are constants of this table. Duplicates stay."""
    own = ents.select(F.col("entity_id").alias("source_entity_id"), provenance_id().alias("provenance_id"))
    out = join_streamed(E.with_taxonomy(edges), own, "source_entity_id")
    return out.select(
        relationship_key().alias("relationship_id"), "source_entity_id", "target_entity_id", F.col("relationship").alias("relationship_type"), "relationship_family", "direction", "inverse_relationship_type",
        F.lit("medium").alias("confidence_tier"), F.greatest(F.lit(1), F.size("supporting_urls")).cast("long").alias("evidence_count"), F.lit("none").alias("conflict_status"),
        F.array(F.lit("source_backed"), F.lit("deterministic_recipe")).alias("quality_flags"), X.stable_id(F.lit("relationship-evidence"), relationship_key()).alias("evidence_id"), "provenance_id", F.lit(fixed.EDGE_RECIPE).alias("recipe_version"),
    )


def relationship_evidence_table(edges: DataFrame, ents: DataFrame) -> DataFrame:
    own = ents.select(F.col("entity_id").alias("source_entity_id"), source_id().alias("source_id"), provenance_id().alias("provenance_id"))
    evidence = X.stable_id(F.lit("relationship-evidence"), relationship_key())
    return edges.join(own, "source_entity_id").select(
        evidence.alias("relationship_evidence_id"), relationship_key().alias("relationship_id"), evidence.alias("evidence_id"), "source_id", F.col("source_entity_id").alias("source_record_id"),
        F.lit("source_backed").alias("evidence_strength"), F.col("relationship").alias("claim"), "provenance_id", F.lit(fixed.TABLE_RECIPE).alias("recipe_version"),
    )


def facets_table(ents: DataFrame) -> DataFrame:
    """Genres, studios, creators and tags, one row per value; duplicates stay."""
    kinds = [("genre", "genres"), ("studio", "studios"), ("creator", "creators"), ("tag", "tags")]

    def rows(kind: str, column: str) -> Column:
        return F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda v: F.struct(F.lit(kind).alias("k"), v.alias("v")))

    every = F.concat(*[rows(k, c) for k, c in kinds])
    out = ents.withColumn("f", F.explode(every))
    return out.select(
        X.stable_id(F.lit("facet"), F.col("entity_id"), F.col("f.k"), F.col("f.v")).alias("facet_id"), "entity_id", F.col("f.k").alias("facet_namespace"), X.slug(F.col("f.v")).alias("facet_key"), F.col("f.v").alias("facet_value"),
        F.lit("medium").alias("confidence_tier"), evidence_id().alias("evidence_id"), provenance_id().alias("provenance_id"), F.lit(fixed.TABLE_RECIPE).alias("recipe_version"),
    )


def source_coverage(ents: DataFrame) -> DataFrame:
    """Per source: role of its first entity by id, sorted domains, count."""
    return ents.groupBy(source_id().alias("source_id")).agg(F.min_by("source_role", "entity_id").alias("source_role"), F.array_sort(F.collect_set("domain")).alias("domains"), F.count("*").alias("record_count"))


def source_snapshots_table(ents: DataFrame, supplied: DataFrame, default_date: str) -> DataFrame:
    """Supplied snapshot rows (source_id, source_snapshot_id, record_count), else defaults for every source seen."""
    kind = F.when(F.col("source_id") == fixed.RELEASE_SOURCE, "release_file").when(F.col("source_id") == "wikidata", "sparql_query_window").otherwise("api_fetch_window")
    seen = ents.groupBy(source_id().alias("source_id")).agg(F.count("*").alias("n"), X.content_hash(F.col("entity_id"), F.col("title")).alias("content_hash"))
    given = supplied.select("source_id", F.col("source_snapshot_id").alias("given_id"), F.col("record_count").alias("given_count"))
    return seen.join(given, "source_id", "left").select(
        F.coalesce("given_id", F.concat_ws(":", "source_id", F.lit(default_date))).alias("source_snapshot_id"), "source_id", kind.alias("snapshot_kind"), F.coalesce("given_count", "n").alias("record_count"), "content_hash",
    )


def provider_runs_table(snapshots: DataFrame) -> DataFrame:
    requests = F.when(F.col("source_id") == fixed.RELEASE_SOURCE, F.lit(0)).otherwise(F.col("record_count")).cast("long")
    return snapshots.select(X.stable_id(F.lit("provider-run"), F.col("source_id"), F.col("source_snapshot_id"), F.lit(fixed.TABLE_RECIPE)).alias("provider_run_id"), "source_id", "source_snapshot_id", requests.alias("request_count"))


def provenance_table(ents: DataFrame, snapshots: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per entity with its source's snapshot and run. There is one snapshot row per source, so both are broadcast."""
    known = snapshots.select("source_id", "source_snapshot_id").join(runs.select("source_id", "provider_run_id"), "source_id")
    return ents.select("entity_id", source_id().alias("source_id"), provenance_id().alias("provenance_id")).join(known, "source_id").select("provenance_id", "source_id", "source_snapshot_id", "provider_run_id", F.lit(fixed.TABLE_RECIPE).alias("recipe_run_id"), F.lit(fixed.POLICY_VERSION).alias("policy_version"))


def source_records_table(ents: DataFrame) -> DataFrame:
    """One row per entity with the hash of its own values."""
    return ents.select("entity_id", source_id().alias("source_id"), X.record_hash("entity_id", "title", "media_type", "status", "release_year").alias("record_hash"))


def profile_table(ents: DataFrame, hints: DataFrame, domain: str) -> DataFrame:
    """Anime, tv or movie profile of the domain's entities. ``hints``: source_entity_id, relationship_hints."""
    own = ents.where(F.col("domain") == domain)
    year = X.zero_to_null(F.col("release_year"))
    if domain == "anime":
        joined = own.join(hints.withColumnRenamed("source_entity_id", "entity_id"), "entity_id", "left")
        return joined.select("entity_id", "media_type", "episodes", year.alias("season_year"), F.coalesce("relationship_hints", F.array().cast("array<string>")).alias("relationship_hints"))
    if domain == "tv":
        return own.select("entity_id", "media_type", "episodes", X.tag_value(F.col("tags"), "network").alias("network"))
    return own.select("entity_id", "media_type", year.alias("release_year"), X.tag_value(F.col("tags"), "franchise").alias("franchise"))


def relationship_hints(edges: DataFrame) -> DataFrame:
    return edges.groupBy("source_entity_id").agg(F.array_sort(F.collect_set("relationship")).alias("relationship_hints"))


def corpus_entities(ents: DataFrame) -> DataFrame:
    """The 18-column entity table of the corpus pair, field lineage as JSON with sorted keys."""
    lineage = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("field_sources"))), {"ignoreNullFields": "false"})
    plain = ["entity_id", "domain", "canonical_source", "source_role", "record_source", "title", "original_title", "media_type", "status", "release_year", "episodes", "synonyms", "sources", "genres", "studios", "creators", "tags"]
    return ents.select(*plain, lineage.alias("field_sources_json"))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in the stated order."""
    return _keep(df, keys, [F.col(c) if isinstance(c, str) else c for c in order])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _keep(df, keys, [F.desc(c) for c in order])


def _keep(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    from pyspark.sql import Window

    return df.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_row = 1").drop("_row")


def union_keep_first(*frames: DataFrame) -> DataFrame:
    """Union of sources; the first source that holds an id wins."""
    marked = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    out = marked[0]
    for f in marked[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return keep_first(out, ["entity_id"], ["_source"]).drop("_source")


def table_row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each frame."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in frames.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def slice_profile(ents: DataFrame, edges: DataFrame) -> DataFrame:
    """(measure, n): titles that occur more than once, entities per domain, edges per type."""
    doubled = ents.groupBy("title").count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit("titles occurring more than once").alias("measure"), "n")
    domains = ents.groupBy(F.concat(F.lit("domain "), "domain").alias("measure")).agg(F.count("*").alias("n"))
    types = edges.groupBy(F.concat(F.lit("edge "), "relationship").alias("measure")).agg(F.count("*").alias("n"))
    return doubled.unionByName(domains).unionByName(types)


def facet_match_all(facets: DataFrame, pairs: list[tuple[str, str]], tiers: list[str], at_least: int | None = None) -> DataFrame:
    """(entity_id, n): entities whose facets of the given tiers match every (namespace, key) pair, or ``at_least`` so many of them."""
    wanted = facets.sparkSession.createDataFrame(sorted(set(pairs)), "facet_namespace string, facet_key string")
    hit = facets.where(F.col("confidence_tier").isin(tiers)).join(F.broadcast(wanted), ["facet_namespace", "facet_key"], "left_semi")
    return hit.groupBy("entity_id").agg(F.countDistinct("facet_namespace", "facet_key").alias("n")).where(F.col("n") >= (len(set(pairs)) if at_least is None else at_least))


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exact columns, order and types of a contract; missing columns become nulls of its type."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in contract])
