"""Quality gates. Each returns findings as rows; ``assert_clean`` raises only where an error row exists."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.rounds import forget, kept
from marquee.functions.skew import dealt, join_dealt
from marquee.operators import tables as B
from marquee.plans import fixed, policies


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def assert_clean(findings: DataFrame) -> None:
    bad = findings.where("severity = 'error'").limit(5).collect()
    if bad:
        raise ValueError("; ".join(str(r.asDict()) for r in bad))


def audit_findings(runs: DataFrame) -> DataFrame:
    """Findings of provider runs: started_at, finished_at, request_count, cache_hit_count, secret_refs, source_snapshot_id."""
    checks = {
        "finished_before_start": F.col("finished_at") < F.col("started_at"),
        "cache_hits_exceed_requests": F.col("cache_hit_count") > F.col("request_count"),
        "secret_in_reference": F.exists("secret_refs", lambda s: reduce(lambda a, b: a | b, [F.lower(s).contains(m) for m in fixed.SECRET_MARKERS])),
        "record_without_snapshot_or_run": F.col("source_snapshot_id").isNull() & F.col("provider_run_id").isNull(),
    }
    found = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))
    return runs.withColumn("finding", F.explode(found)).select("run_key", "finding")


def snapshot_findings(snapshots: DataFrame) -> DataFrame:
    """Snapshots (source_snapshot_id, fetch_window_started_at, fetch_window_finished_at, record_count) whose window is inverted or whose count is negative."""
    checks = {"fetch_window_inverted": F.col("fetch_window_finished_at") < F.col("fetch_window_started_at"), "negative_record_count": F.col("record_count") < 0}
    found = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))
    return snapshots.select("source_snapshot_id", F.explode(found).alias("finding"))


def identity_findings(changes: DataFrame) -> DataFrame:
    """Findings of identity changes: change_type, old_entity_id, new_entity_ids."""
    from pyspark.sql import Window

    n = F.size("new_entity_ids")
    kind = F.col("change_type")
    checks = {
        "targets_itself": F.array_contains("new_entity_ids", F.col("old_entity_id")),
        "repeated_target": n != F.size(F.array_distinct("new_entity_ids")),
        "split_needs_two": (kind == "split") & (n < 2),
        "needs_one_target": kind.isin("merge", "redirect", "supersession") & (n != 1),
        "needs_no_target": kind.isin("deprecation", "withdrawal") & (n != 0),
        "several_changes_of_one_id": F.count("*").over(Window.partitionBy("old_entity_id")) > 1,
    }
    found = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks.items()]))
    return changes.withColumn("found", found).select("old_entity_id", F.explode("found").alias("finding"))


def resolve_identity(ids: DataFrame, changes: DataFrame, folder: str) -> DataFrame:
    """(entity_id, current_id): ids followed through changes until none applies; withdrawn ids have no row. A cycle that an id reaches is an error.

    Every changed id holds the set of ids it leads to, and each round replaces those that are changed themselves by their own
    sets, which doubles the reach: a chain of n changes takes some log2(n) rounds, each a table in ``folder``. Whatever is
    still open after as many rounds as the number of changed ids asks for runs in a cycle.
    """
    changed = changes.select(F.col("old_entity_id").alias("at")).distinct()
    mark = lambda df: df.join(changed.select(F.col("at").alias("to"), F.lit(True).alias("open")), "to", "left").select("at", "to", F.coalesce("open", F.lit(False)).alias("open"))
    reach = mark(changes.select(F.col("old_entity_id").alias("at"), F.explode("new_entity_ids").alias("to")).distinct())
    rounds = changed.count().bit_length() + 1
    reach, left = kept(reach, folder, "identity", F.col("open"))
    while left and rounds:
        ahead = reach.select(F.col("at").alias("to"), F.col("to").alias("far"), F.col("open").alias("far_open"))
        further = reach.where("open").join(ahead, "to").select("at", F.col("far").alias("to"), F.col("far_open").alias("open"))
        now, left = kept(reach.where("not open").unionByName(further).distinct(), folder, "identity", F.col("open"))
        forget(reach)
        reach, rounds = now, rounds - 1
    wanted = ids.select("entity_id").distinct()
    if left and not reach.where("open").join(wanted.withColumnRenamed("entity_id", "at"), "at", "left_semi").isEmpty():
        raise ValueError("identity changes form a cycle")
    moved = reach.where("not open").select(F.col("at").alias("entity_id"), F.col("to").alias("current_id"))
    same = wanted.join(changed.withColumnRenamed("at", "entity_id"), "entity_id", "left_anti").select("entity_id", F.col("entity_id").alias("current_id"))
    return moved.join(wanted, "entity_id", "left_semi").unionByName(same)


def null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """Nulls in required columns, all in one scan."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return one.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in required]), F.array(*required))).alias("column_name", "nulls"))


def orphan_refs(a: DataFrame, key: str, b: DataFrame, other: str) -> DataFrame:
    """Non-null references of ``a`` that ``b`` doesn't hold."""
    return join_dealt(a.where(F.col(key).isNotNull()), b.select(F.col(other).alias(key)), key, "left_anti")


def domain_coverage(ents: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Entities per domain, and how many of them have a row in the table."""
    have = table.select(F.col(key).alias("entity_id")).distinct().withColumn("has", F.lit(1))
    return ents.join(have, "entity_id", "left").groupBy("domain").agg(F.count("*").alias("entities"), F.count("has").alias("covered"))


def release_findings(frames: dict[str, DataFrame], required: dict[str, list[str]], domains: list[str], sources: list[str]) -> DataFrame:
    """Findings of a release: empty or missing tables, missing domains and sources, nulls in required columns, orphan references, repeated keys."""
    spark = next(iter(frames.values())).sparkSession
    out = []
    add = lambda df, rule, severity="error": out.append(df.select(F.lit(rule).alias("rule"), F.col("subject").cast("string").alias("subject"), F.lit(severity).alias("severity")))
    missing = [n for n in required if n not in frames]
    add(spark.createDataFrame([(n,) for n in missing], "subject string"), "missing_table")
    for name, df in frames.items():
        add(df.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(name).alias("subject")), "empty_table")
        if required.get(name):
            add(null_counts(df, required[name]).where("nulls > 0").select(F.concat(F.lit(name + "."), "column_name").alias("subject")), "null_in_required_column")
    ents = frames["entities"]
    wanted = spark.createDataFrame([(x,) for x in domains], "domain string")
    add(wanted.join(ents.select("domain").distinct(), "domain", "left_anti").select(F.col("domain").alias("subject")), "missing_domain")
    known = spark.createDataFrame([(x,) for x in sources], "source_id string")
    add(known.join(frames["external_ids"].select("source_id").distinct(), "source_id", "left_anti").select(F.col("source_id").alias("subject")), "missing_source")
    add(frames["external_ids"].where(~F.col("source_role").isin(fixed.PUBLIC_ROLE, "ID_SOURCE")).select(F.col("entity_id").alias("subject")).distinct(), "role_not_public")
    for side in ("source_entity_id", "target_entity_id"):
        add(orphan_refs(frames["relationships"].select(side).distinct(), side, ents, "entity_id").select(F.col(side).alias("subject")), f"orphan_{side}")
    facets = frames["facets"].select("facet_id")
    # Keys hardly repeat, so they are dealt before they are counted, by rows: a task that counts what it reads holds nearly every key of it.
    add(dealt(facets, facets.count(), "facet_id").groupBy("facet_id").count().where("count > 1").select(F.col("facet_id").alias("subject")), "repeated_key", "warning")
    return _union(out)


def set_difference(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(have.select(key), key, "left_anti")


def row_changes(previous: DataFrame, current: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys that were added, removed or whose values changed between snapshots."""
    mark = lambda df, name: df.select(*keys, F.xxhash64(*values).alias(name), F.lit(True).alias(f"in_{name}"))
    both = mark(previous, "before").join(mark(current, "after"), keys, "full")
    kind = F.when(F.col("in_before").isNull(), "added").when(F.col("in_after").isNull(), "removed").when(F.col("before") != F.col("after"), "changed")
    return both.withColumn("change", kind).where("change is not null").select(*keys, "change")


def vanished_ids(previous: DataFrame, current: DataFrame, changes: DataFrame) -> DataFrame:
    """Entity ids that are gone although no identity change names them."""
    gone = set_difference(previous, current, "entity_id")
    return gone.join(changes.select(F.col("old_entity_id").alias("entity_id")), "entity_id", "left_anti")


@dataclass(frozen=True)
class Contract:
    """What a release promises of one table."""

    columns: list[str]
    schema_version: str = "core.v1"
    tier: str = "core"
    filled: bool = True  # a release may not be empty here


@dataclass(frozen=True)
class Release:
    """What a release must be."""

    artifact: str = "media-metadata-v1"
    core_schema_version: str = "core.v1"
    domains: tuple[str, ...] = ("anime", "tv", "movie")
    sources: tuple[str, ...] = ("manami", "tvmaze", "wikidata")
    roles: tuple[str, ...] = (fixed.PUBLIC_ROLE, "ID_SOURCE")


def measured(frames: dict[str, DataFrame]) -> DataFrame:
    """(table_name, columns, row_count) of frames as they are."""
    return _union([df.agg(F.lit(name).alias("table_name"), F.array(*[F.lit(c) for c in df.columns]).alias("columns"), F.count("*").alias("row_count")) for name, df in frames.items()])


def manifest_findings(manifest: DataFrame, entries: DataFrame, files: DataFrame, coverage: DataFrame, actual: DataFrame, contracts: dict[str, Contract], release: Release = Release()) -> DataFrame:
    """(rule, subject, severity) of a release's manifest.

    ``manifest`` is one row (artifact, dataset_line, core_schema_version, dataset_version, domains); ``entries`` has a row for
    each table (table_name, path, schema_version, compatibility_tier, row_count); ``files`` lists paths; ``coverage`` has source_id,
    source_role, source_snapshot_id; ``actual`` is what ``measured`` finds. All are a row per table or source: nothing here grows with data.
    """
    spark, out = manifest.sparkSession, []
    add = lambda df, rule, subject: out.append(df.select(F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), F.lit("error").alias("severity")))
    for column, want in (("artifact", release.artifact), ("dataset_line", release.artifact), ("core_schema_version", release.core_schema_version)):
        add(manifest.where(~F.col(column).eqNullSafe(F.lit(want))), f"{column}_mismatch", F.col(column))
    add(manifest.where(F.coalesce("dataset_version", F.lit("")) == ""), "dataset_version_missing", F.col("artifact"))
    add(manifest.select(F.explode(F.array_except(F.array(*[F.lit(x) for x in release.domains]), F.coalesce("domains", F.array().cast("array<string>")))).alias("d")), "required_domains_missing", F.col("d"))
    add(coverage.where(F.col("source_snapshot_id").isNull() | F.endswith("source_snapshot_id", F.lit(":unspecified"))), "source_snapshot_unspecified", F.col("source_id"))
    add(coverage.where(~F.coalesce(F.col("source_role").isin(*release.roles), F.lit(False))), "source_role_not_public", F.col("source_id"))
    sources = spark.createDataFrame([(x,) for x in release.sources], "source_id string")
    add(sources.join(coverage, "source_id", "left_anti"), "required_sources_missing", F.col("source_id"))
    wanted = spark.createDataFrame([(n, c.columns, c.schema_version, c.tier, c.filled) for n, c in contracts.items()], "table_name string, want_columns array<string>, want_version string, want_tier string, filled boolean")
    add(wanted.join(entries, "table_name", "left_anti"), "required_tables_missing", F.col("table_name"))
    listed = files.select(F.col("path"), F.lit(True).alias("listed")).distinct()
    own = entries.join(wanted, "table_name").join(listed, "path", "left").join(actual.select("table_name", F.col("columns").alias("have"), F.col("row_count").alias("rows")), "table_name", "left")
    path, there = F.coalesce("path", F.lit("")), F.col("have").isNotNull()
    rules = {
        "table_path_missing": path == "",
        "table_path_invalid": path.startswith("/") | path.contains(".."),
        "table_file_missing_from_manifest": (path != "") & F.col("listed").isNull(),
        "table_file_missing": (path != "") & ~there,
        "schema_version_mismatch": ~F.col("schema_version").eqNullSafe(F.col("want_version")),
        "compatibility_tier_mismatch": ~F.col("compatibility_tier").eqNullSafe(F.col("want_tier")),
        "columns_mismatch": there & (F.col("have") != F.col("want_columns")),
        "row_count_mismatch": there & ~F.col("row_count").eqNullSafe(F.col("rows")),
        "table_empty": there & F.col("filled") & (F.col("rows") == 0),
    }
    for rule, bad in rules.items():
        add(own.where(bad), rule, F.col("table_name"))
    return _union(out)


def domain_row_findings(ents: DataFrame, tables: dict[str, DataFrame], profiles: dict[str, DataFrame], domains: list[str]) -> DataFrame:
    """Domains without entities, and domains none of whose entities has a row in one of the tables or in the domain's profile."""
    spark = ents.sparkSession
    wanted = spark.createDataFrame([(x,) for x in domains], "domain string")
    have = ents.select("domain").distinct()
    out = [wanted.join(have, "domain", "left_anti").select(F.lit("domain_entities_missing").alias("rule"), F.col("domain").alias("subject"))]
    for name, df in [*tables.items(), *profiles.items()]:
        own = have if name in tables else have.where(F.col("domain") == name)
        some = ents.join(df.select("entity_id"), "entity_id", "left_semi").select("domain").distinct()
        rule = f"domain_{name}_missing" if name in tables else "domain_profile_missing"
        out.append(own.join(wanted, "domain", "left_semi").join(some, "domain", "left_anti").select(F.lit(rule), F.col("domain")))
    return _union([f.toDF("rule", "subject").withColumn("severity", F.lit("error")) for f in out])


def metadata_findings(tables: dict[str, DataFrame], snapshots: DataFrame, runs: DataFrame) -> DataFrame:
    """(rule, subject, severity): tables with rows whose snapshot or run the metadata tables don't hold."""
    out = []
    for name, df in tables.items():
        for rule, key, known in (("source_snapshot_join_missing", "source_snapshot_id", snapshots), ("provider_run_join_missing", "provider_run_id", runs)):
            # One row per key that is used, so nothing of the table's size is joined.
            missing = orphan_refs(df.select(key).distinct(), key, known, key).limit(1)
            out.append(missing.select(F.lit(rule).alias("rule"), F.lit(name).alias("subject"), F.lit("error").alias("severity")))
    return _union(out)


def table_tier(name: Column, tier: Column) -> Column:
    """The stated tier, or the one that a table's name stands for."""
    by_name = (F.when(name.contains("profile"), "profile").when(name.isin("relationships", "entities"), "core")
               .when(name.startswith("llm-") | name.startswith("llm_") | name.contains("judgment") | name.contains("materialized"), "derived").otherwise("experimental"))
    return F.when(tier.isin("core", "profile", "derived", "experimental"), tier).otherwise(by_name)


def compatibility_findings(previous: DataFrame, current: DataFrame, artifact_versions: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """(table_name, rule, severity) between manifests (table_name, schema_version, compatibility_tier, recipe_version).

    Removed tables and higher schema majors are errors in the core and warnings elsewhere; changed recipes are warnings; experimental
    tables of the current manifest are listed as info; a lower major of the artifact itself is an error without a table.
    """
    major = lambda c: F.nullif(F.regexp_extract(c, r"(?:^|v)(\d+)", 1), F.lit("")).cast("long")
    p = previous.select("table_name", F.col("schema_version").alias("v0"), table_tier(F.col("table_name"), F.col("compatibility_tier")).alias("tier"), F.col("recipe_version").alias("r0"))
    j = p.join(current.select("table_name", F.col("schema_version").alias("v1"), F.col("recipe_version").alias("r1"), F.lit(True).alias("here")), "table_name", "left")
    weight = F.when(F.col("tier") == "core", "error").otherwise("warning").alias("severity")
    found = F.array_compact(F.array(
        F.when(F.col("here").isNull(), F.struct(F.lit("removed_table").alias("rule"), weight)),
        F.when(F.col("here") & (major(F.col("v1")) > major(F.col("v0"))), F.struct(F.lit("schema_major_changed").alias("rule"), weight)),
        F.when(F.col("here") & (F.col("r0") != F.col("r1")), F.struct(F.lit("recipe_changed").alias("rule"), F.lit("warning").alias("severity"))),
    ))
    out = j.select("table_name", F.explode(found).alias("f")).select("table_name", "f.rule", "f.severity")
    loose = current.where(table_tier(F.col("table_name"), F.col("compatibility_tier")) == "experimental")
    out = out.unionByName(loose.select("table_name", F.lit("experimental_surface").alias("rule"), F.lit("info").alias("severity")))
    versions = previous.sparkSession.createDataFrame([artifact_versions], "a string, b string").where(major(F.col("b")) < major(F.col("a")))
    return out.unionByName(versions.select(F.lit(None).cast("string").alias("table_name"), F.lit("artifact_major_regressed").alias("rule"), F.lit("error").alias("severity")))


def policy_violations(ents: DataFrame, columns: list[str], use: str) -> DataFrame:
    """(source_id, column, rule, rows): source and column pairs with values that the policies don't allow for a use."""
    spark = ents.sparkSession
    filled = lambda c: F.count(F.when(F.size(c) > 0, 1)) if dict(ents.dtypes)[c].startswith("array") else F.count(c)
    seen = ents.groupBy(B.source_id().alias("source_id")).agg(*[filled(c).alias(c) for c in columns])
    pairs = seen.select("source_id", F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*columns))).alias("column", "rows")).where("rows > 0")
    sources = F.broadcast(spark.createDataFrame(policies.source_rows(), "source_id string, source_role string, source_uses array<string>"))
    fields = F.broadcast(spark.createDataFrame(policies.field_rows(), "source_id string, column string, class string, field_uses array<string>"))
    artifact = F.broadcast(spark.createDataFrame([(c, u, k) for _, _, c, u, k in policies.artifact_rows(columns)], "column string, artifact_uses array<string>, classes array<string>").dropDuplicates(["column"]))
    j = pairs.join(sources, "source_id", "left").join(fields, ["source_id", "column"], "left").join(artifact, "column", "left")
    rules = F.array_compact(F.array(
        F.when(F.col("artifact_uses").isNull(), "missing_artifact_policy"),
        F.when(~F.array_contains("artifact_uses", use), "artifact_use_not_allowed"),
        F.when(F.col("source_uses").isNull(), "missing_source_policy"),
        F.when(~F.array_contains("source_uses", use), "source_use_not_allowed"),
        F.when(F.col("source_uses").isNotNull() & F.col("field_uses").isNull(), "missing_field_policy"),
        F.when(~F.array_contains("field_uses", use), "field_use_not_allowed"),
        F.when(~F.array_contains("classes", F.col("class")), "class_not_allowed"),
    ))
    return j.select("source_id", "column", F.explode(rules).alias("rule"), "rows")


def redact(ents: DataFrame, columns: list[str], use: str) -> DataFrame:
    """Entities without rows of sources that don't allow the use, and with columns nulled that don't."""
    spark = ents.sparkSession
    allowed: dict[str, list[str]] = {}
    for source, field, _, uses in policies.field_rows():
        if use in uses and use in policies.ROLE_USES[policies.SOURCES[source]]:
            allowed.setdefault(source, []).append(field)
    rows = F.broadcast(spark.createDataFrame(list(allowed.items()), "_source string, _fields array<string>"))
    out = ents.join(rows, B.source_id() == F.col("_source"))
    nulled = {c: F.when(F.array_contains("_fields", c), F.col(c)) for c in columns}
    return out.withColumns(nulled).drop("_source", "_fields")
