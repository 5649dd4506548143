"""Queries for quality gates, policies and identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.cases.searching import folder
from marquee.operators import gates as G
from marquee.operators import tables as B
from marquee.plans import testbed
from marquee.plans.testbed import duck

COLUMNS = ["title", "original_title", "media_type", "status", "release_year", "episodes", "synonyms", "sources", "genres", "studios", "creators", "tags"]


def audit(spark, d):
    runs = testbed.table(spark, d, "events").selectExpr("event_id run_key", "ts started_at", "ts + make_interval(0, 0, 0, 0, 0, cast(value - 5 as int)) finished_at", "user_id request_count", "cast(value as bigint) cache_hit_count", "array(concat('env:', event_type), if(event_type = 'error', 'Bearer abc', props)) secret_refs", "if(event_id % 2 = 0, null, 's') source_snapshot_id", "if(event_id % 3 = 0, null, 'r') provider_run_id")
    return G.audit_findings(runs)


def _changes(spark, d):
    kind = F.when(F.col("s_nationkey") % 3 == 0, "split").when(F.col("s_nationkey") % 3 == 1, "merge").otherwise("withdrawal")
    new = F.when(F.col("s_nationkey") % 5 == 0, F.array(F.col("s_suppkey"), F.col("s_suppkey") + 1)).when(F.col("s_nationkey") % 5 == 1, F.array(F.col("s_suppkey") + 1, F.col("s_suppkey") + 1)).when(F.col("s_nationkey") % 5 == 2, F.array(F.col("s_suppkey") + 1)).otherwise(F.array().cast("array<bigint>"))
    return testbed.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("old_entity_id"), kind.alias("change_type"), new.cast("array<string>").alias("new_entity_ids"))


def identity_checks(spark, d):
    return G.identity_findings(_changes(spark, d))


def identity_resolution(spark, d):
    """Suppliers 7n+1..7n+6 move on step by step to 7n+7; those of nation 0 are withdrawn."""
    s = testbed.table(spark, d, "supplier")
    changes = s.where("s_suppkey % 7 <> 0 or s_nationkey = 0").select(F.col("s_suppkey").cast("string").alias("old_entity_id"), F.when(F.col("s_nationkey") == 0, F.array().cast("array<string>")).otherwise(F.array((F.col("s_suppkey") + 1).cast("string"))).alias("new_entity_ids"))
    return G.resolve_identity(s.select(F.col("s_suppkey").cast("string").alias("entity_id")), changes, folder(spark))


def nulls(spark, d):
    return G.null_counts(testbed.entities(spark, d), ["entity_id", "original_title", "episodes", "release_year"])


def orphans(spark, d):
    return G.orphan_refs(testbed.table(spark, d, "orders"), "o_orderkey", testbed.table(spark, d, "lineitem"), "l_orderkey").select("o_orderkey", "o_custkey")


def coverage(spark, d):
    return G.domain_coverage(testbed.entities(spark, d), testbed.edges(spark, d), "source_entity_id")


def set_difference(spark, d):
    return G.set_difference(testbed.table(spark, d, "nation").select(F.col("n_nationkey").alias("k")), testbed.table(spark, d, "supplier").select((F.col("s_nationkey") + 1).alias("k")), "k")


def release(spark, d):
    ents, edges = testbed.entities(spark, d), testbed.edges(spark, d)
    frames = {"entities": B.entities_table(ents), "external_ids": B.external_ids_table(ents), "relationships": B.relationships_table(edges, ents), "facets": B.facets_table(ents), "identity_changes": B.entities_table(ents).where("domain = 'book'")}
    required = {"entities": ["entity_id", "release_year"], "external_ids": ["url"], "relationships": [], "facets": [], "titles": [], "identity_changes": []}
    return G.release_findings(frames, required, ["anime", "tv", "movie", "book"], ["manami", "tvmaze", "wikidata", "openlibrary"])


def changes(spark, d):
    return G.row_changes(testbed.previous_edges(spark, d), testbed.edges(spark, d), ["source_entity_id", "target_entity_id"], ["relationship"])


def vanished(spark, d):
    ents = testbed.entities(spark, d)
    named = testbed.table(spark, d, "supplier").where("s_nationkey < 5").select(F.concat(F.lit("tv:tvmaze:"), "s_suppkey").alias("old_entity_id"))
    return G.vanished_ids(ents, ents.where("domain <> 'tv'"), named)


def compatibility(spark, d):
    """Tables named after nations; those of region 4 state no tier and are profiles by name, those of region 3 none by name either."""
    n = testbed.table(spark, d, "nation")
    name = F.when(F.col("n_regionkey") == 4, F.concat("n_name", F.lit("_profile"))).otherwise(F.col("n_name")).alias("table_name")
    tier = F.when(F.col("n_regionkey") < 2, "core").when(F.col("n_regionkey") == 2, "derived").alias("compatibility_tier")
    before = n.select(name, F.concat(F.lit("core.v"), (F.col("n_nationkey") % 3 + 1).cast("string")).alias("schema_version"), tier, F.when(F.col("n_nationkey") % 5 > 0, "r1").alias("recipe_version"))
    after = n.where("n_nationkey > 4").select(name, F.concat(F.lit("core.v"), (F.col("n_nationkey") % 2 + 1).cast("string")).alias("schema_version"), tier, F.concat(F.lit("r"), (F.col("n_nationkey") % 3).cast("string")).alias("recipe_version"))
    return G.compatibility_findings(before, after, ("2.1", "1.9"))


def snapshots(spark, d):
    rows = testbed.table(spark, d, "events").selectExpr("concat('s', event_id) source_snapshot_id", "ts fetch_window_started_at", "ts + make_interval(0, 0, 0, 0, 0, cast(value - 7 as int)) fetch_window_finished_at", "cast(value as bigint) - 2 record_count")
    return G.snapshot_findings(rows)


def manifest(spark, d):
    """The given tables as a release: nation has region's count, region another tier, supplier another version, part no path, orders an unlisted file,
    customer one column less, lineitem no entry, and an empty table is added."""
    names = ["region", "nation", "customer", "supplier", "part", "orders"]
    frames = {n: testbed.table(spark, d, n) for n in names} | {"hollow": testbed.table(spark, d, "region").where("r_regionkey < 0")}
    actual = G.measured(frames)
    contracts = {n: G.Contract(df.columns if n != "customer" else df.columns[:-1]) for n, df in frames.items()} | {"lineitem": G.Contract(["l_orderkey"])}
    t = F.col("table_name")
    regions = actual.where("table_name = 'region'").first().row_count
    entries = actual.select("table_name", F.when(t != "part", F.concat(t, F.lit(".parquet"))).alias("path"), F.when(t == "supplier", "core.v0").otherwise("core.v1").alias("schema_version"), F.when(t == "region", "profile").otherwise("core").alias("compatibility_tier"), F.when(t == "nation", F.lit(regions)).otherwise(F.col("row_count")).alias("row_count"))
    files = entries.where("table_name <> 'orders' and path is not null").select("path")
    coverage = B.source_coverage(testbed.entities(spark, d)).where("source_id <> 'wikidata'").select("source_id", F.when(F.col("source_id") == "tvmaze", "LOCAL_EVIDENCE").otherwise(F.col("source_role")).alias("source_role"), F.concat("source_id", F.when(F.col("source_id") == "manami", ":unspecified").otherwise(":2026-04-27")).alias("source_snapshot_id"))
    head = testbed.entities(spark, d).agg(F.lit("media-metadata-v1").alias("artifact"), F.lit("other").alias("dataset_line"), F.lit("core.v2").alias("core_schema_version"), F.lit("").alias("dataset_version"), F.array_except(F.collect_set("domain"), F.array(F.lit("tv"))).alias("domains"))
    return G.manifest_findings(head, entries, files, coverage, actual, contracts)


def domain_rows(spark, d):
    ents = testbed.entities(spark, d)
    hints = B.relationship_hints(testbed.edges(spark, d))
    tables = {"titles": B.titles_table(ents.where("domain <> 'tv'")), "external_ids": B.external_ids_table(ents), "source_records": B.source_records_table(ents.where("domain = 'tv'"))}
    profiles = {"anime": B.profile_table(ents, hints, "anime"), "movie": B.profile_table(ents.where("release_year < 0"), hints, "movie")}
    return G.domain_row_findings(ents, tables, profiles, ["anime", "tv", "movie", "book"])


def metadata_joins(spark, d):
    ents = testbed.entities(spark, d)
    supplied = spark.createDataFrame([], "source_id string, source_snapshot_id string, record_count long")
    snaps = B.source_snapshots_table(ents, supplied, "2026-04-01")
    runs = B.provider_runs_table(snaps)
    provenance = B.provenance_table(ents, snaps, runs)
    return G.metadata_findings({"provenance": provenance, "shows": provenance.where("source_id = 'tvmaze'")}, snaps, runs.where("source_id <> 'manami'"))


def _mixed(spark, d):
    """Entities of which two nations' shows come from a source for local matching and one nation's from an unknown one."""
    n = F.element_at(F.split(F.element_at("tags", 1), "_"), -1)
    source = F.when((F.col("domain") == "tv") & n.isin("1", "2"), "anilist").when((F.col("domain") == "tv") & (n == "3"), "unheard").when((F.col("domain") == "tv") & (n == "4"), "thetvdb").otherwise(F.col("record_source"))
    return testbed.entities(spark, d).withColumn("record_source", source)


def violations(spark, d):
    return G.policy_violations(_mixed(spark, d), COLUMNS, "PUBLIC_PARQUET")


def redacted(spark, d):
    out = G.redact(_mixed(spark, d), ["title", "episodes", "sources"], "RETRIEVAL_TEXT")
    return out.select("entity_id", "title", "episodes", F.col("sources").isNull().alias("no_sources"))


_MIXED = """m as (select * replace (case when domain = 'tv' and split_part(tags[1], '_', 2) in ('1', '2') then 'anilist' when domain = 'tv' and split_part(tags[1], '_', 2) = '3' then 'unheard' when domain = 'tv' and split_part(tags[1], '_', 2) = '4' then 'thetvdb' when domain = 'anime' then 'manami' else record_source end as record_source) from v_ent)"""
_VIOLATIONS = f"""with {_MIXED}, f as (""" + " union all ".join(f"select record_source source_id, '{c}' col, count(*) \"rows\" from m where {c} is not null and {'len(' + c + ') > 0' if c in ('synonyms', 'sources', 'genres', 'studios', 'creators', 'tags') else 'true'} group by 1" for c in COLUMNS) + """)
 select source_id, col "column", unnest(case when source_id = 'anilist' then ['source_use_not_allowed', 'field_use_not_allowed', 'class_not_allowed'] when source_id = 'unheard' then ['missing_source_policy'] when source_id = 'thetvdb' and col <> 'sources' then ['missing_field_policy'] else [] end) "rule", "rows" from f"""
_SUP = "s as (select s_suppkey k, s_nationkey n, case s_nationkey % 3 when 0 then 'split' when 1 then 'merge' else 'withdrawal' end kind, case s_nationkey % 5 when 0 then [s_suppkey, s_suppkey + 1] when 1 then [s_suppkey + 1, s_suppkey + 1] when 2 then [s_suppkey + 1] else cast([] as bigint[]) end nw from supplier)"

CASES = {
    "f_audit": (audit, "with e as (select *, trunc(value - 5)::int sec from events) select event_id run_key, unnest(list_filter([case when sec < 0 then 'finished_before_start' end, case when trunc(value)::bigint > user_id then 'cache_hits_exceed_requests' end, case when event_type = 'error' then 'secret_in_reference' end, case when event_id % 6 = 0 then 'record_without_snapshot_or_run' end], lambda x: x is not null)) finding from e"),
    "f_identity_changes": (identity_checks, f"with {_SUP} select k::varchar old_entity_id, unnest(list_filter([case when list_contains(nw, k) then 'targets_itself' end, case when n % 5 = 1 then 'repeated_target' end, case when kind = 'split' and len(nw) < 2 then 'split_needs_two' end, case when kind = 'merge' and len(nw) <> 1 then 'needs_one_target' end, case when kind = 'withdrawal' and len(nw) <> 0 then 'needs_no_target' end], lambda x: x is not null)) finding from s"),
    "q_resolve_identity": (identity_resolution, "with recursive w as (select s_suppkey k, case when s_nationkey = 0 then -1 when s_suppkey % 7 <> 0 then s_suppkey + 1 end nx from supplier), r as (select k, k pl from w union all select r.k, w.nx from r join w on w.k = r.pl where nx is not null and nx >= 0) select k::varchar entity_id, pl::varchar current_id from r where not exists (select 1 from w x where x.k = r.pl and x.nx is not null)"),
    "a_null_counts": (nulls, duck("select 'entity_id' column_name, 0 nulls union all select 'original_title', count(*) - count(original_title) from v_ent union all select 'episodes', count(*) - count(episodes) from v_ent union all select 'release_year', 0", "v_ent")),
    "j_orphans": (orphans, "select o_orderkey, o_custkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)"),
    "j_domain_coverage": (coverage, duck("select domain, count(*) entities, count(*) filter (entity_id in (select source_entity_id from v_edge)) covered from v_ent group by 1", "v_ent", "v_edge")),
    "u_set_difference": (set_difference, "select distinct n_nationkey k from nation where n_nationkey not in (select s_nationkey + 1 from supplier)"),
    "q_release_findings": (release, duck("""with e as (select * from v_ent), o as (select distinct source_entity_id from v_edge where source_entity_id not in (select entity_id from e)), t as (select distinct target_entity_id from v_edge where target_entity_id not in (select entity_id from e)), s as (select distinct source_entity_id x from v_edge semi join e on entity_id = source_entity_id)
 select 'missing_table' "rule", 'titles' subject, 'error' severity union all select 'empty_table', 'identity_changes', 'error' union all select 'missing_domain', 'book', 'error' union all select 'missing_source', 'openlibrary', 'error' union all select 'null_in_required_column', 'entities.release_year', 'error' union all select 'orphan_target_entity_id', target_entity_id, 'error' from t""", "v_ent", "v_edge")),
    "q_row_changes": (changes, duck("select source_entity_id, target_entity_id, case when k % 10 = 0 then 'added' else 'changed' end change from v_edge where k % 10 = 0 or k % 7 = 0", "v_edge")),
    "q_vanished_ids": (vanished, "select 'tv:tvmaze:'||s_suppkey entity_id from supplier where s_nationkey >= 5"),
    "q_compatibility": (compatibility, """with n as (select *, n_nationkey > 4 here, n_name||case when n_regionkey = 4 then '_profile' else '' end t, case when n_regionkey < 2 then 'error' else 'warning' end w from nation)
 select t table_name, 'removed_table' "rule", w severity from n where not here union all select t, 'schema_major_changed', w from n where here and n_nationkey % 2 > n_nationkey % 3 union all select t, 'recipe_changed', 'warning' from n where here and n_nationkey % 5 > 0 and n_nationkey % 3 <> 1
 union all select t, 'experimental_surface', 'info' from n where here and n_regionkey = 3 union all select null, 'artifact_major_regressed', 'error'"""),
    "f_snapshots": (snapshots, "with e as (select *, trunc(value - 7)::int sec from events) select 's'||event_id source_snapshot_id, unnest(list_filter([case when sec < 0 then 'fetch_window_inverted' end, case when trunc(value)::bigint < 2 then 'negative_record_count' end], lambda x: x is not null)) finding from e"),
    "q_manifest": (manifest, """select * from (values ('dataset_line_mismatch', 'other', 'error'), ('core_schema_version_mismatch', 'core.v2', 'error'), ('dataset_version_missing', 'media-metadata-v1', 'error'), ('required_domains_missing', 'tv', 'error'), ('source_snapshot_unspecified', 'manami', 'error'), ('source_role_not_public', 'tvmaze', 'error'), ('required_sources_missing', 'wikidata', 'error'),
 ('required_tables_missing', 'lineitem', 'error'), ('table_path_missing', 'part', 'error'), ('table_file_missing_from_manifest', 'orders', 'error'), ('schema_version_mismatch', 'supplier', 'error'), ('compatibility_tier_mismatch', 'region', 'error'), ('columns_mismatch', 'customer', 'error'), ('table_empty', 'hollow', 'error')) t("rule", subject, severity)
 union all select 'row_count_mismatch', 'nation', 'error' where (select count(*) from nation) <> (select count(*) from region)"""),
    "q_domain_rows": (domain_rows, duck("select 'domain_entities_missing' \"rule\", 'book' subject, 'error' severity where not exists (select 1 from v_ent where domain = 'book') union all select distinct 'domain_titles_missing', domain, 'error' from v_ent where domain = 'tv' union all select distinct 'domain_source_records_missing', domain, 'error' from v_ent where domain <> 'tv' union all select distinct 'domain_profile_missing', domain, 'error' from v_ent where domain = 'movie' and not exists (select 1 from v_ent where domain = 'movie' and release_year < 0)", "v_ent")),
    "q_metadata_joins": (metadata_joins, duck("select 'provider_run_join_missing' \"rule\", 'provenance' subject, 'error' severity where exists (select 1 from v_ent where record_source like 'manami%')", "v_ent")),
    "p_policy_violations": (violations, duck(_VIOLATIONS, "v_ent")),
    "p_redact": (redacted, duck(f"with {_MIXED} select entity_id, title, null::int episodes, true no_sources from m where record_source not in ('anilist', 'unheard', 'thetvdb')", "v_ent")),
}
