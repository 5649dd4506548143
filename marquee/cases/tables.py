"""Queries for edge scoring and table builders."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.cases.searching import folder
from marquee.functions import exprs as X
from marquee.operators import edges as E
from marquee.operators import ingest as I
from marquee.operators import tables as B
from marquee.plans import fixed, testbed
from marquee.plans.testbed import duck
from marquee.sources import readers as R
from marquee.sources import writers as W
from marquee.streaming import incremental as N


def _joined(df, *columns):
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def edge_scores(spark, d):
    out = E.scored(testbed.edges(spark, d))
    return _joined(out, "quality_flags").select("source_entity_id", "target_entity_id", "relationship", "supporting_source_count", "supporting_provider_count", "relationship_family", "direction", "inverse_relationship_type", "score", "quality_flags", "confidence_tier", "confidence_profile_json")


def relation_rules(spark, d):
    feed = testbed.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus").distinct()
    kind = F.element_at(F.array(*[F.lit(x) for x in ("sequel", "PREQUEL", "SPIN_OFF", "SUMMARY", "PARENT", "CONTAINS", "ALTERNATIVE")]), F.col("l_linenumber"))
    form = F.when(F.col("l_linestatus") == "F", "MOVIE").when(F.col("l_orderkey") % 2 == 0, "OVA")
    out = feed.withColumn("r", E.relation_rule(kind, form))
    return out.groupBy("l_linenumber", "l_linestatus", F.col("r.relationship").alias("relationship"), F.col("r.reason").alias("reason")).agg(F.count("*").alias("n"))


def corpus_edges(spark, d):
    out = E.corpus_relationships(testbed.edges(spark, d))
    return _joined(out, "quality_flags", "supporting_urls").select("relationship_id", "source_entity_id", "target_entity_id", "evidence_id", "evidence_count", "supporting_urls", "relationship_confidence_score", "recipe_version", "conflict_status")


def entities(spark, d):
    return _joined(B.entities_table(testbed.entities(spark, d)), "quality_flags").drop("release_date")


def titles(spark, d):
    return _joined(B.titles_table(testbed.entities(spark, d)), "quality_flags").drop("language", "script")


def external_ids(spark, d):
    return B.external_ids_table(testbed.entities(spark, d))


def relationships(spark, d):
    return _joined(B.relationships_table(testbed.edges(spark, d), testbed.entities(spark, d)), "quality_flags")


def evidence(spark, d):
    return B.relationship_evidence_table(testbed.edges(spark, d), testbed.entities(spark, d))


def facets(spark, d):
    return B.facets_table(testbed.entities(spark, d))


def coverage(spark, d):
    return _joined(B.source_coverage(testbed.entities(spark, d)), "domains")


def _audit(spark, d):
    ents = testbed.entities(spark, d)
    supplied = ents.where("record_source = 'tvmaze'").groupBy(F.lit("tvmaze").alias("source_id")).agg(F.lit("tvmaze:2026-04-27").alias("source_snapshot_id"), (F.count("*") + 1).alias("record_count"))
    snapshots = B.source_snapshots_table(ents, supplied, "2026-04-01")
    return ents, snapshots, B.provider_runs_table(snapshots)


def snapshots(spark, d):
    return _audit(spark, d)[1]


def provider_runs(spark, d):
    return _audit(spark, d)[2]


def provenance(spark, d):
    return B.provenance_table(*_audit(spark, d))


def source_records(spark, d):
    return B.source_records_table(testbed.entities(spark, d))


def anime_profile(spark, d):
    return _joined(B.profile_table(testbed.entities(spark, d), B.relationship_hints(testbed.edges(spark, d)), "anime"), "relationship_hints")


def tv_profile(spark, d):
    return B.profile_table(testbed.entities(spark, d), B.relationship_hints(testbed.edges(spark, d)), "tv")


def movie_profile(spark, d):
    return B.profile_table(testbed.entities(spark, d), B.relationship_hints(testbed.edges(spark, d)), "movie")


def corpus_entities(spark, d):
    return _joined(B.corpus_entities(testbed.anime(spark, d)), "synonyms", "sources", "genres", "studios", "creators", "tags")


def first_and_last(spark, d):
    ev = testbed.table(spark, d, "events")
    first = B.keep_first(ev, ["user_id"], ["ts", "event_id"]).select("user_id", F.col("event_id").alias("first_event"))
    last = B.keep_last(ev, ["user_id"], ["ts", "event_id"]).select("user_id", F.col("event_id").alias("last_event"))
    return first.join(last, "user_id")


def union_first(spark, d):
    ents = testbed.entities(spark, d).select("entity_id", "title")
    again = ents.withColumn("title", F.lit("again")).unionByName(ents.select(F.concat("entity_id", F.lit("x")).alias("entity_id"), "title"))
    return B.union_keep_first(ents, again).groupBy("title").agg(F.count("*").alias("n"))


def conformed(spark, d):
    contract = T.StructType([T.StructField("entity_id", T.StringType()), T.StructField("release_year", T.LongType()), T.StructField("release_date", T.DateType()), T.StructField("domain", T.StringType())])
    return B.conform(testbed.entities(spark, d), contract).select("entity_id", "release_year", "domain", F.col("release_date").isNull().alias("no_date"))


def row_counts(spark, d):
    return B.table_row_counts({n: testbed.table(spark, d, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")})


def slice_profile(spark, d):
    return B.slice_profile(testbed.entities(spark, d), testbed.edges(spark, d))


def _facets(spark, d):
    return B.facets_table(testbed.anime(spark, d))


def facet_match_some(spark, d):
    return B.facet_match_all(_facets(spark, d), [("tag", "small"), ("tag", "red"), ("genre", "economy"), ("studio", "brand#2")], ["medium", "high"], at_least=2)


def facet_match_every(spark, d):
    return B.facet_match_all(_facets(spark, d), [("tag", "small"), ("tag", "red")], ["medium", "high"])


def written(spark, d):
    """What is written is read again: counts of the manifest beside those of the files."""
    ents, edges = testbed.entities(spark, d), testbed.edges(spark, d)
    place = f"{folder(spark)}/written-{uuid.uuid4().hex}"
    rows = W.write_tables({"titles": B.titles_table(ents), "facets": B.facets_table(ents), "relationships": B.relationships_table(edges, ents)}, place)
    again = B.table_row_counts({n: spark.read.parquet(f"{place}/{n}.parquet") for n in ("titles", "facets", "relationships")}).withColumnRenamed("row_count", "read_count")
    return rows.join(again, "table_name").select("table_name", "path", "row_count", "read_count", "schema_version", "compatibility_tier", "policy_version", "recipe_version")


def catalog(spark, d):
    """The corpus pair written and read: edges whose source is no entity are dropped."""
    place = f"{folder(spark)}/catalog-{uuid.uuid4().hex}"
    ents = testbed.anime(spark, d).where("release_year > 2000")
    W.write_corpus(B.corpus_entities(ents), E.corpus_relationships(testbed.edges(spark, d)), place)
    own, edges = R.read_catalog(spark, f"{place}/entities.parquet", f"{place}/relationships.parquet")
    return edges.groupBy("relationship").agg(F.count("*").alias("n"), F.countDistinct("source_entity_id").alias("sources")).withColumn("entities", F.lit(own.count()))


def landed(spark, d):
    """Entities written as JSON lines, with a broken line for each supplier, and read again."""
    place = f"{folder(spark)}/landed-{uuid.uuid4().hex}"
    ents = testbed.entities(spark, d).drop("field_sources")
    W.write_jsonl(ents, f"{place}/good")
    odd = F.when(F.col("s_suppkey") % 2 == 0, F.lit("no json")).otherwise(F.lit('{"entity_id": "x", "other": 1}'))
    testbed.table(spark, d, "supplier").select(odd.alias("value")).write.text(f"{place}/odd")
    good, bad = R.read_entities(spark, f"{place}/good", f"{place}/odd")
    n = good.groupBy(F.concat(F.lit("domain "), "domain").alias("kind")).agg(F.count("*").alias("n"), F.sum(F.size("tags")).alias("tags"))
    return n.unionByName(bad.groupBy(F.col("reason").alias("kind")).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("tags")))


def strict_landed(spark, d):
    """Documents written as entity lines with planted faults: what is read as good, and why the others are not."""
    place = f"{folder(spark)}/strict-{uuid.uuid4().hex}"
    testbed.raw_entities(spark, d).write.text(place)
    good, bad = R.read_entities(spark, place)
    doc = lambda c: F.regexp_extract(c, r"doc:(\d+)", 1).cast("long").alias("doc_id")
    none = lambda kind: F.lit(None).cast(kind)
    rows = good.select(doc("record_source"), none("string").alias("reason"), none("string").alias("detail"), "release_year", F.size("related").alias("edges"), F.md5(F.array_join("synonyms", "|")).alias("synonyms_md5"))
    return rows.unionByName(bad.select(doc("value"), "reason", "detail", none("int").alias("release_year"), none("int").alias("edges"), none("string").alias("synonyms_md5")))


def shows_landed(spark, d):
    """Suppliers written as show payloads, one JSON object a line, and read again."""
    place = f"{folder(spark)}/shows-{uuid.uuid4().hex}"
    k = F.col("s_suppkey")
    network = F.when(k % 3 == 0, F.struct(F.concat(F.lit("net "), "s_nationkey").alias("name")))
    episodes = F.struct(F.transform(F.sequence(F.lit(1), (k % 4 + 1).cast("int")), lambda i: F.struct(i.alias("id"))).alias("episodes"))
    rows = testbed.table(spark, d, "supplier").select(k.alias("id"), F.concat(F.lit("https://www.tvmaze.com/shows/"), k).alias("url"), F.col("s_name").alias("name"), F.lit("Scripted").alias("type"), F.array(F.lit("Drama"), F.lit(" "), F.when(k % 2 == 0, "Comedy").otherwise("Drama")).alias("genres"), F.lit("2001-02-03").alias("premiered"), network.alias("network"), F.struct(F.concat(F.lit("tt"), k).alias("imdb"), (k * 2).alias("thetvdb")).alias("externals"), episodes.alias("_embedded"))
    rows.select(F.to_json(F.struct("*")).alias("value")).write.text(place)
    return R.read_show_payloads(spark, place).select("id", "name", F.array_join("genres", "|").alias("genres"), "premiered", "imdb", "tvdb", "network", "episodes")


#: Records of one landed document.
PAGE = 1000


def _paged(df, key, document):
    """Documents (a text each) of PAGE records, a file each: ``document`` makes one of the records' aggregate."""
    low = df.agg(F.min(key)).first()[0] or 0
    return df.withColumn("page", F.floor((F.col(key) - low) / PAGE)).groupBy("page").agg(document.alias("value"))


def release_landed(spark, d):
    """Suppliers as release documents, written and read again; a record's place goes on from one document to the next."""
    place = f"{folder(spark)}/release-{uuid.uuid4().hex}"
    k = F.col("s_suppkey")
    row = F.struct(k.alias("k"), F.col("s_name").alias("title"), F.lit("TV").alias("type"), F.lit("FINISHED").alias("status"), F.array(F.concat(F.lit("https://anidb.net/anime/"), k)).alias("sources"), F.struct(F.lit("FALL").alias("season"), (F.lit(1990) + k % 30).alias("year")).alias("animeSeason"), F.array(F.lit("a"), F.col("s_name")).alias("synonyms"), (k % 12).alias("episodes"))
    document = F.to_json(F.struct(F.first("page").cast("string").alias("repository"), F.lit("2026-04-01").alias("lastUpdate"), F.array_sort(F.collect_list(row)).alias("data")))
    _paged(testbed.table(spark, d, "supplier"), "s_suppkey", document).write.partitionBy("page").text(place)
    pos = (F.col("repository").cast("int") * PAGE + F.col("pos")).alias("pos")
    return R.read_release(spark, place).select("lastUpdate", pos, "title", "year", "episodes", F.array_join("sources", "|").alias("sources"), F.array_join("synonyms", "|").alias("synonyms"))


def bindings_landed(spark, d):
    """Customers as documents of SPARQL results, written and read again."""
    place = f"{folder(spark)}/bindings-{uuid.uuid4().hex}"
    k = F.col("c_custkey")
    value = lambda v: F.struct(v.cast("string").alias("value"))
    row = F.struct(value(F.concat(F.lit("http://www.wikidata.org/entity/Q"), k)).alias("item"), F.when(k % 3 > 0, value(F.col("c_name"))).alias("itemLabel"), value(F.concat(F.lit("b|"), "c_mktsegment", F.lit("| |b"))).alias("genres"), value(k / 2).alias("runtime"))
    document = F.to_json(F.struct(F.struct(F.collect_list(row).alias("bindings")).alias("results")))
    _paged(testbed.table(spark, d, "customer"), "c_custkey", document).write.partitionBy("page").text(place)
    return R.read_sparql_bindings(spark, place).select("qid", "label", F.array_join("genres", "|").alias("genres"), "runtime_minutes")


def snapshot_written(spark, d):
    """The same bundle under its snapshot and as the current one."""
    place = f"{folder(spark)}/bundle-{uuid.uuid4().hex}"
    ents = testbed.entities(spark, d)
    rows = W.materialize_snapshot({"titles": B.titles_table(ents), "entities": B.entities_table(ents)}, place, "anime", "s1")
    read = lambda df: B.table_row_counts({n: df(n) for n in ("titles", "entities")})
    kept = read(lambda n: spark.read.parquet(f"{place}/snapshots/anime/s1/{n}.parquet")).withColumnRenamed("row_count", "kept")
    return rows.select("table_name", "row_count").join(kept, "table_name").join(read(W.current(spark, place, "anime")[1].get).withColumnRenamed("row_count", "current"), "table_name")


def audit_landed(spark, d):
    """Two files of audit rows: the later file's row of a source counts."""
    place = f"{folder(spark)}/audit-{uuid.uuid4().hex}"
    n = testbed.table(spark, d, "nation")
    W.write_jsonl(n.select(F.col("n_name").alias("source_id"), F.lit(1).alias("v")), f"{place}/a")
    W.write_jsonl(n.where("n_nationkey < 10").select(F.col("n_name").alias("source_id"), F.lit(2).alias("v")), f"{place}/b")
    return R.read_audit(spark, "source_id string, v int", f"{place}/a", f"{place}/b")


def best_titles(spark, d):
    """Documents as search results of their language, those of source and length as title, episodes and year."""
    rows = testbed.table(spark, d, "documents").select(F.col("lang").alias("search"), F.col("doc_id").alias("pos"), F.when(F.col("doc_id") % 10 == 0, F.upper("lang")).otherwise(F.col("source")).alias("romaji"), F.lit(None).cast("string").alias("english"), F.lit(None).cast("string").alias("native"), (F.col("n_chars") % 7).cast("int").alias("episodes"), (F.lit(1990) + F.col("n_chars") % 11).cast("int").alias("year"), F.concat(F.lit("u"), "doc_id").alias("url"))
    return I.best_title_result(rows).select("search", "pos", "episodes", "year", "url")


def snapshot_times(spark, d):
    e = testbed.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit("manami:unspecified")).otherwise(F.concat(F.lit("tvmaze:"), F.date_format("ts", "yyyy-MM-dd"))).alias("id"))
    return e.select("event_id", F.date_format(X.snapshot_time(F.col("id")), "yyyy-MM-dd").alias("day"))


def credits(spark, d):
    """Parts with invented studios and staff."""
    k = F.col("p_partkey")
    studios = F.array(F.struct((k % 2 == 0).alias("isMain"), F.col("p_brand").alias("name")), F.struct(F.lit(False).alias("isMain"), F.lit("second").alias("name")))
    staff = F.array(F.struct(F.lit("Original  Creator").alias("role"), F.when(k % 3 == 0, "").otherwise(F.col("p_type")).alias("full"), F.lit("native").alias("native")), F.struct(F.lit("Director").alias("role"), F.lit("d").alias("full"), F.lit("n").alias("native")))
    return testbed.table(spark, d, "part").select("p_partkey", F.array_join(X.main_or_all(studios), "|").alias("studios"), F.array_join(X.creator_names(staff), "|").alias("creators"))


def finalized(spark, d):
    """A job for each supplier; one of them, and one without state, is finished."""
    state = testbed.table(spark, d, "supplier").selectExpr("concat('job', s_suppkey) job", "'s1' snapshot_id", "'in_progress' status", "cast(s_suppkey as long) next_offset", "cast(null as string) last_checkpoint_path")
    return N.finalize(N.finalize(state, "job1"), "other").select("job", "snapshot_id", "status", "next_offset")


_SOURCE = "case when record_source like 'manami-project/anime-offline-database%' then 'manami' else record_source end"
_H = "left(sha256({}), 16)"
_EVID = "'evidence:'||" + _H.format("entity_id")
_PROV = f"'provenance:'||{_SOURCE}||':'||" + _H.format("entity_id")
_RID = "'relationship:'||source_entity_id||':'||relationship||':'||" + _H.format("target_entity_id")
_TAX = "t(relationship, family, direction, inverse, deterministic) as (values " + ", ".join(f"('{r}', '{f}', '{w}', {repr(i) if i else 'null'}, {str(x).lower()})" for r, f, w, i, x in fixed.TAXONOMY) + ")"
_BASE = "case relationship " + " ".join(f"when '{r}' then {v}::double" for r, v in fixed.BASE_CONFIDENCE.items()) + " else 0.4::double end"
_SCORED = f"""with {_TAX}, c as (select e.*, family, direction, inverse, deterministic, len(supporting_urls) n, len(list_distinct(list_transform(supporting_urls, lambda u: regexp_extract(u, '//([^/]+)/', 1)))) p,
 len(list_filter(supporting_urls, lambda u: u like 'https://anilist.co/%')) > 0 has from v_edge e join t using (relationship)), s as (select *, round(least({_BASE} + least(n - 1, 5) * 0.04::double + least(p - 1, 4) * 0.05::double + case when has and relationship <> 'related_anime' then 0.06::double else 0 end, 0.98), 2) score,
 'source_backed'||case when deterministic then '|deterministic_recipe' else '' end||case when relationship = 'related_anime' then '|legacy_broad_type|judgment_candidate' else '' end flags from c), f as (select *, case when relationship = 'related_anime' then 'review' when score >= 0.8 then 'high' when score >= 0.6 then 'medium' else 'low' end tier from s) """
_PROFILE = """'{"agreement_status":"'||case when p >= 2 then 'multi_provider' else 'single_provider' end||'","confidence_tier":"'||tier||'","evidence_origin":"source_backed_relationship","evidence_strength":"'||case when n >= 3 and p >= 2 then 'strong' else 'moderate' end||'","extraction_method":"'||case when deterministic then 'deterministic' else 'source_broad_label' end||'","freshness_status":"snapshot_current","quality_flags":["'||replace(flags, '|', '","')||'"],"recipe_version":"relationship-taxonomy-v1","score_scope":"recipe_local"}'"""
_EDGE_ROWS = f"with {_TAX}, e as (select v_edge.*, {_PROV} prov, {_SOURCE} sid from v_edge join v_ent on entity_id = source_entity_id) "
_FACETS = f"""with f as (select entity_id, record_source, 'genre' k, unnest(genres) v from v_ent union all select entity_id, record_source, 'studio', unnest(studios) from v_ent union all select entity_id, record_source, 'creator', unnest(creators) from v_ent union all select entity_id, record_source, 'tag', unnest(tags) from v_ent) """
_TITLES = "with t as (select entity_id, record_source, title, 'canonical' k from v_ent union all select entity_id, record_source, original_title, 'original' from v_ent where original_title <> title union select entity_id, record_source, s, 'alias' from (select *, unnest(synonyms) s from v_ent) where s <> title) "
_SNAPS = f"""with s as (select {_SOURCE} source_id, count(*) n, sha256(string_agg(title, chr(10) order by entity_id)) content_hash from v_ent group by 1), sn as (select case when source_id = 'tvmaze' then 'tvmaze:2026-04-27' else source_id||':2026-04-01' end source_snapshot_id, source_id,
 case source_id when 'manami' then 'release_file' when 'wikidata' then 'sparql_query_window' else 'api_fetch_window' end snapshot_kind, case when source_id = 'tvmaze' then n + 1 else n end record_count, content_hash from s), r as (select 'provider-run:'||source_id||':'||source_snapshot_id||':'||{_H.format("'core-v1'")} provider_run_id, source_id, source_snapshot_id, case when source_id = 'manami' then 0 else record_count end request_count from sn) """

CASES = {
    "c_edge_scores": (edge_scores, duck(_SCORED + f"select source_entity_id, target_entity_id, relationship, n supporting_source_count, p supporting_provider_count, family relationship_family, direction, inverse inverse_relationship_type, score, flags quality_flags, tier confidence_tier, {_PROFILE} confidence_profile_json from f", "v_edge")),
    "c_relation_rules": (relation_rules, """with f as (select distinct l_orderkey, l_linenumber, l_linestatus from lineitem), g as (select l_linenumber, l_linestatus, ['SEQUEL', 'PREQUEL', 'SPIN_OFF', 'SUMMARY', 'PARENT', 'CONTAINS', 'ALTERNATIVE'][l_linenumber] kind, case when l_linestatus = 'F' then 'MOVIE' when l_orderkey % 2 = 0 then 'OVA' end form from f),
 h as (select *, case when kind = 'SEQUEL' then 'sequel' when kind = 'PREQUEL' then 'prequel' when kind = 'SPIN_OFF' then 'spinoff' when kind = 'SUMMARY' then 'recap' when kind in ('PARENT', 'CONTAINS') then case form when 'MOVIE' then 'movie_tie_in' when 'OVA' then 'special' end end relationship from g) select l_linenumber, l_linestatus, relationship, case when relationship is null then 'anilist_relation_type:'||kind end reason, count(*) n from h group by all"""),
    "b_corpus_edges": (corpus_edges, duck(_SCORED + """select 'relationship:'||left(sha256('{"relationship":"'||relationship||'","source_entity_id":"'||source_entity_id||'","target_entity_id":"'||target_entity_id||'"}'), 20) relationship_id, source_entity_id, target_entity_id,
 'relationship-evidence:'||left(sha256('{"relationship":"'||relationship||'","source_entity_id":"'||source_entity_id||'","supporting_urls":["'||array_to_string(supporting_urls, '","')||'"],"target_entity_id":"'||target_entity_id||'"}'), 20) evidence_id, n evidence_count, array_to_string(supporting_urls, '|') supporting_urls, score relationship_confidence_score, 'relationship-taxonomy-v1' recipe_version, 'none' conflict_status from f""", "v_edge")),
    "b_entities": (entities, duck(f"select entity_id, domain, media_type, status, nullif(release_year, 0)::bigint release_year, 'high' confidence_tier, greatest(1, len(sources)) evidence_count, 'none' conflict_status, 'source_backed' quality_flags, {_EVID} evidence_id, {_PROV} provenance_id, 'core-v1' recipe_version, 'entities' manifest_table_name from v_ent", "v_ent")),
    "b_titles": (titles, duck(_TITLES + f"select 'title:'||entity_id||':'||k||':'||{_H.format('title')} title_id, entity_id, title, k title_type, {_SOURCE} source_id, {_EVID} evidence_id, {_PROV} provenance_id, case when k = 'canonical' then 'high' else 'medium' end confidence_tier, 'source_backed' quality_flags, 'core-v1' recipe_version from t", "v_ent")),
    "b_external_ids": (external_ids, duck(f"select 'external-id:'||entity_id||':'||{_H.format('record_source')} external_id_row_id, entity_id, {_SOURCE} source_id, source_role, string_split(entity_id, ':')[-1] external_id, canonical_source url, {_PROV} provenance_id, 'core-v1' recipe_version from v_ent", "v_ent")),
    "b_relationships": (relationships, duck(_EDGE_ROWS + f"select {_RID} relationship_id, source_entity_id, target_entity_id, relationship relationship_type, family relationship_family, direction, inverse inverse_relationship_type, 'medium' confidence_tier, len(supporting_urls) evidence_count, 'none' conflict_status, 'source_backed|deterministic_recipe' quality_flags, 'relationship-evidence:'||{_H.format(_RID)} evidence_id, prov provenance_id, 'relationship-taxonomy-v1' recipe_version from e join t using (relationship)", "v_ent", "v_edge")),
    "b_relationship_evidence": (evidence, duck(_EDGE_ROWS + f"select 'relationship-evidence:'||{_H.format(_RID)} relationship_evidence_id, {_RID} relationship_id, 'relationship-evidence:'||{_H.format(_RID)} evidence_id, sid source_id, source_entity_id source_record_id, 'source_backed' evidence_strength, relationship claim, prov provenance_id, 'core-v1' recipe_version from e", "v_ent", "v_edge")),
    "b_facets": (facets, duck(_FACETS + f"select 'facet:'||entity_id||':'||k||':'||{_H.format('v')} facet_id, entity_id, k facet_namespace, replace(lower(trim(v)), ' ', '_') facet_key, v facet_value, 'medium' confidence_tier, {_EVID} evidence_id, {_PROV} provenance_id, 'core-v1' recipe_version from f", "v_ent")),
    "a_source_coverage": (coverage, duck(f"select {_SOURCE} source_id, arg_min(source_role, entity_id) source_role, array_to_string(list_sort(list(distinct domain)), '|') domains, count(*) record_count from v_ent group by 1", "v_ent")),
    "b_source_snapshots": (snapshots, duck(_SNAPS + "select * from sn", "v_ent")),
    "b_provider_runs": (provider_runs, duck(_SNAPS + "select * from r", "v_ent")),
    "b_provenance": (provenance, duck(_SNAPS + f"select {_PROV} provenance_id, {_SOURCE} source_id, r.source_snapshot_id, provider_run_id, 'core-v1' recipe_run_id, 'source-policy-v1' policy_version from v_ent join r on r.source_id = {_SOURCE}", "v_ent")),
    "b_source_records": (source_records, duck(f"""select entity_id, {_SOURCE} source_id, left(sha256('{{"entity_id":"'||entity_id||'","title":"'||title||'","media_type":"'||media_type||'","status":"'||status||'","release_year":'||release_year||'}}'), 16) record_hash from v_ent""", "v_ent")),
    "b_anime_profile": (anime_profile, duck("select entity_id, any_value(media_type) media_type, any_value(episodes) episodes, any_value(nullif(release_year, 0)) season_year, coalesce(string_agg(distinct relationship, '|' order by relationship), '') relationship_hints from v_ent left join v_edge on source_entity_id = entity_id where domain = 'anime' group by 1", "v_ent", "v_edge")),
    "b_tv_profile": (tv_profile, duck("select entity_id, media_type, episodes, substr(tags[1], 9) network from v_ent where domain = 'tv'", "v_ent")),
    "b_movie_profile": (movie_profile, duck("select entity_id, media_type, nullif(release_year, 0) release_year, substr(tags[1], 11) franchise from v_ent where domain = 'movie'", "v_ent")),
    "b_corpus_entities": (corpus_entities, duck("""select * replace (array_to_string(synonyms, '|') as synonyms, array_to_string(sources, '|') as sources, genres[1] as genres, studios[1] as studios, creators[1] as creators, array_to_string(tags, '|') as tags), '{"status":["'||canonical_source||'"],"title":["'||canonical_source||'"]}' field_sources_json from v_anime""", "v_anime")),
    "w_first_and_last": (first_and_last, "select user_id, arg_min(event_id, (ts, event_id)) first_event, arg_max(event_id, (ts, event_id)) last_event from events group by 1"),
    "u_union_first": (union_first, duck("select title, 2 * count(*) n from v_ent group by 1", "v_ent")),
    "b_conform": (conformed, duck("select entity_id, release_year::bigint release_year, domain, true no_date from v_ent", "v_ent")),
    "a_row_counts": (row_counts, " union all ".join(f"select '{t}' table_name, count(*) row_count from {t}" for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"))),
    "a_slice_profile": (slice_profile, duck("select 'titles occurring more than once' measure, count(*) n from (select title from v_ent group by 1 having count(*) > 1) union all select 'domain '||domain, count(*) from v_ent group by 1 union all select 'edge '||relationship, count(*) from v_edge group by 1", "v_ent", "v_edge")),
    "a_facet_match_all": (facet_match_some, duck("select entity_id, (list_contains(tags, 'small')::int + list_contains(tags, 'red')::int + (media_type = 'ECONOMY')::int + (studios[1] = 'Brand#2')::int)::bigint n from v_anime where n >= 2", "v_anime")),
    "a_facet_match_every": (facet_match_every, duck("select entity_id, 2::bigint n from v_anime where list_contains(tags, 'small') and list_contains(tags, 'red')", "v_anime")),
    "s_written": (written, duck(_TITLES + ", n as (select 'titles' t, count(*) c from t union all select 'facets', sum(len(genres) + len(studios) + len(creators) + len(tags)) from v_ent union all select 'relationships', count(*) from v_edge semi join v_ent on entity_id = source_entity_id) select t table_name, t||'.parquet' path, c::bigint row_count, c::bigint read_count, 'core.v1' schema_version, 'core' compatibility_tier, 'source-policy-v1' policy_version, 'core-v1' recipe_version from n", "v_ent", "v_edge")),
    "s_catalog": (catalog, duck("with a as (select entity_id from v_anime where release_year > 2000) select relationship, count(*) n, count(distinct source_entity_id) sources, (select count(*)::int from a) entities from v_edge where source_entity_id in (select entity_id from a) group by 1", "v_anime", "v_edge")),
    "s_shows": (shows_landed, "select s_suppkey::int id, s_name \"name\", case when s_suppkey % 2 = 0 then 'Comedy|Drama' else 'Drama' end genres, '2001-02-03' premiered, 'tt'||s_suppkey imdb, (s_suppkey * 2)::int tvdb, case when s_suppkey % 3 = 0 then 'net '||s_nationkey end network, (s_suppkey % 4 + 1)::int episodes from supplier"),
    "s_release": (release_landed, "select '2026-04-01' \"lastUpdate\", (row_number() over (order by s_suppkey) - 1)::int pos, s_name title, (1990 + s_suppkey % 30)::int \"year\", (s_suppkey % 12)::int episodes, 'https://anidb.net/anime/'||s_suppkey sources, 'a|'||s_name synonyms from supplier"),
    "s_bindings": (bindings_landed, "select 'Q'||c_custkey qid, case when c_custkey % 3 > 0 then c_name else 'Q'||c_custkey end label, case when c_mktsegment < 'b' then c_mktsegment||'|b' else 'b|'||c_mktsegment end genres, floor(c_custkey / 2)::int runtime_minutes from customer"),
    "s_snapshot": (snapshot_written, duck(_TITLES + ", n as (select 'titles' t, count(*) c from t union all select 'entities', count(*) from v_ent) select t table_name, c row_count, c kept, c \"current\" from n", "v_ent")),
    "s_audit": (audit_landed, "select n_name source_id, case when n_nationkey < 10 then 2 else 1 end::int v from nation"),
    "n_best_titles": (best_titles, "with r as (select lang, doc_id, n_chars % 7 e, 1990 + n_chars % 11 y, row_number() over (partition by lang order by (doc_id % 10 = 0 or source = lang) desc, n_chars % 7 desc, 1990 + n_chars % 11 desc, doc_id) i from documents) select lang search, doc_id pos, e::int episodes, y::int \"year\", 'u'||doc_id url from r where i = 1"),
    "x_snapshot_times": (snapshot_times, "select event_id, case when event_id % 3 = 0 then '1970-01-01' else strftime(ts, '%Y-%m-%d') end \"day\" from events"),
    "x_credits": (credits, "select p_partkey, case when p_partkey % 2 = 0 then p_brand else p_brand||'|second' end studios, case when p_partkey % 3 = 0 then 'native' else p_type end creators from part"),
    "i_finalize": (finalized, "select 'job'||s_suppkey job, 's1' snapshot_id, case when s_suppkey = 1 then 'completed' else 'in_progress' end status, s_suppkey::bigint next_offset from supplier union all select 'other', null, 'completed', 0"),
    "s_strict": (strict_landed, """with c as (select doc_id, text, n_chars, doc_id % 13 k from documents where doc_id is not null), r as (select *, case when k in (1, 3, 6, 7, 8, 10) then 'wrong_type' when k in (2, 5, 12) then 'missing_required_field' when k = 4 then 'unknown_key' when k = 11 then 'not_an_object' end reason from c)
 select doc_id, reason, case k when 1 then 'release_year' when 2 then 'entity_id' when 3 then 'related.1.target' when 4 then 'related.1.more' when 5 then 'related.1.target_url' when 6 then 'title' when 7 then 'synonyms.1' when 8 then 'field_sources.title' when 10 then 'source_role' when 11 then '' when 12 then 'status' end detail,
 case when reason is null then case k when 9 then 2009 else 1950 + n_chars % 70 end::int end release_year, case when reason is null then 2 end edges, case when reason is null then md5(text) end synonyms_md5 from r"""),
    "s_landed": (landed, duck("select 'domain '||domain kind, count(*) n, sum(len(tags))::bigint tags from v_ent group by 1 union all select case when s_suppkey % 2 = 0 then 'not_an_object' else 'unknown_key' end, count(*), 0 from supplier group by 1", "v_ent")),
}
