"""Relationship edges: support counts, confidence, taxonomy, flags, tiers, profiles and rules of the relation feed.

An edge frame has source_entity_id, pos, target_entity_id, relationship, target_url, supporting_urls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.plans import fixed


def taxonomy(spark) -> DataFrame:
    return spark.createDataFrame(fixed.TAXONOMY, "relationship string, relationship_family string, direction string, inverse_relationship_type string, deterministic boolean")


def evidence_urls(urls: Column, target_url: Column) -> Column:
    """Distinct supporting URLs; the target's own where there are none."""
    return F.when(F.size(urls) > 0, F.array_distinct(urls)).otherwise(F.array(target_url))


def with_support(edges: DataFrame) -> DataFrame:
    """Adds supporting_source_count and supporting_provider_count. Null URL lists count as empty."""
    urls = evidence_urls(F.coalesce("supporting_urls", F.array().cast("array<string>")), F.col("target_url"))
    providers = F.when(F.size(urls) == 1, F.lit(1)).otherwise(F.size(F.array_distinct(F.transform(urls, X.provider_of))))  # one page needs no parsing
    return edges.withColumn("supporting_source_count", F.size(urls).cast("long")).withColumn("supporting_provider_count", providers.cast("long"))


def with_taxonomy(edges: DataFrame) -> DataFrame:
    """Adds family, direction, inverse and whether the type is deterministic; unknown types are uncertain."""
    known = F.broadcast(taxonomy(edges.sparkSession))
    out = edges.join(known, "relationship", "left")
    return out.withColumns({"relationship_family": F.coalesce("relationship_family", F.lit("uncertain")), "direction": F.coalesce("direction", F.lit("unknown")), "deterministic": F.coalesce("deterministic", F.lit(False))})


def confidence(relationship: Column, sources: Column, providers: Column, raw_urls: Column) -> Column:
    """Base by type plus bonuses for sources, providers and a typed edge's AniList page; at most 0.98, two decimals."""
    base = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in fixed.BASE_CONFIDENCE.items() for x in pair]), relationship), F.lit(fixed.OTHER_BASE))
    more = lambda n, cap, weight: F.least(F.greatest(n - 1, F.lit(0)), F.lit(cap)) * weight
    typed = F.when((relationship != "related_anime") & F.exists(raw_urls, lambda u: X.provider_of(u) == "anilist"), 0.06).otherwise(0.0)
    return F.round(F.least(base + more(sources, 5, 0.04) + more(providers, 4, 0.05) + typed, F.lit(0.98)), 2)


def flags(relationship: Column, family: Column, deterministic: Column) -> Column:
    return F.array_compact(F.array(
        F.lit("source_backed"),
        F.when(deterministic, "deterministic_recipe"),
        F.when(relationship.isin(fixed.LEGACY_RELATIONSHIPS), "legacy_broad_type"),
        F.when((family == "uncertain") | (relationship == "related_anime"), "judgment_candidate"),
    ))


def tier(score: Column, quality: Column) -> Column:
    return F.when(F.array_contains(quality, "judgment_candidate"), "review").when(score >= 0.8, "high").when(score >= 0.6, "medium").otherwise("low")


def profile_json(sources: Column, providers: Column, deterministic: Column, tier_: Column, quality: Column) -> Column:
    agreement = F.when(providers >= 2, "multi_provider").when(providers == 1, "single_provider").otherwise("no_provider")
    strength = F.when((sources >= 3) & (providers >= 2), "strong").when(sources >= 1, "moderate").otherwise("weak")
    return X.canonical_json(
        agreement_status=agreement, confidence_tier=tier_, evidence_origin=F.lit("source_backed_relationship"), evidence_strength=strength,
        extraction_method=F.when(deterministic, "deterministic").otherwise("source_broad_label"), freshness_status=F.lit("snapshot_current"),
        quality_flags=quality, recipe_version=F.lit(fixed.EDGE_RECIPE), score_scope=F.lit("recipe_local"),
    )


def with_score(edges: DataFrame) -> DataFrame:
    """Edges with support counts and confidence score alone."""
    out = with_support(edges)
    urls = F.coalesce("supporting_urls", F.array().cast("array<string>"))
    return out.withColumn("score", confidence(F.col("relationship"), F.col("supporting_source_count"), F.col("supporting_provider_count"), urls))


def scored(edges: DataFrame) -> DataFrame:
    """Edges with support, taxonomy, confidence score, flags, tier and profile."""
    out = with_taxonomy(with_score(edges))
    out = out.withColumn("quality_flags", flags(F.col("relationship"), F.col("relationship_family"), F.col("deterministic")))
    out = out.withColumn("confidence_tier", tier(F.col("score"), F.col("quality_flags")))
    return out.withColumn("confidence_profile_json", profile_json(F.col("supporting_source_count"), F.col("supporting_provider_count"), F.col("deterministic"), F.col("confidence_tier"), F.col("quality_flags")))


def relation_rule(relation_type: Column, target_format: Column) -> Column:
    """struct(relationship, reason): a precise type, or why the relation waits for a judgment."""
    kind = F.upper(relation_type)
    plain = F.try_element_at(F.create_map(*[F.lit(x) for pair in fixed.RELATION_RULES.items() for x in pair]), kind)
    by_format = F.try_element_at(F.create_map(*[F.lit(x) for pair in fixed.FORMAT_RULES.items() for x in pair]), F.coalesce(target_format, F.lit("")))
    found = F.coalesce(plain, F.when(kind.isin("PARENT", "CONTAINS"), by_format))
    return F.struct(found.alias("relationship"), F.when(found.isNull(), F.concat(F.lit("anilist_relation_type:"), kind)).alias("reason"))


def corpus_relationships(edges: DataFrame) -> DataFrame:
    """The 20-column edge table of the corpus pair."""
    urls = evidence_urls(F.coalesce("supporting_urls", F.array().cast("array<string>")), F.col("target_url"))
    effective = F.when(F.size(F.coalesce("supporting_urls", F.array().cast("array<string>"))) > 0, F.col("supporting_urls")).otherwise(F.array("target_url"))
    out = scored(edges)
    key = {"source_entity_id": F.col("source_entity_id"), "target_entity_id": F.col("target_entity_id"), "relationship": F.col("relationship")}
    return out.select(
        X.json_id("relationship", **key).alias("relationship_id"), "source_entity_id", "target_entity_id", F.col("relationship").alias("relationship_type"),
        "relationship_family", "direction", "inverse_relationship_type", "confidence_tier", F.col("supporting_source_count").alias("evidence_count"),
        F.lit("none").alias("conflict_status"), "quality_flags", X.json_id("relationship-evidence", **key, supporting_urls=urls).alias("evidence_id"),
        F.lit(None).cast("string").alias("provenance_id"), F.lit(fixed.EDGE_RECIPE).alias("recipe_version"), "target_url", effective.alias("supporting_urls"),
        "supporting_source_count", "supporting_provider_count", F.col("score").alias("relationship_confidence_score"), "confidence_profile_json",
    )
