"""Queries for slices, validation, normalisation, canonical targets and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import edges as E
from marquee.operators import ingest as I
from marquee.plans import testbed
from marquee.plans.testbed import duck


def _join(df, *columns):
    return df.withColumns({c: F.array_join(c, "|") for c in columns})


def filtered_titles(spark, d):
    return I.title_contains(testbed.entities(spark, d), "title", " RED ").select("entity_id", "title")


def validated(spark, d):
    return I.validate(testbed.candidates(spark, d)).select("pos", "reason", "detail")


def validated_raw(spark, d):
    """Landed JSON of every document, judged by the kinds it really holds."""
    out = I.validate_raw(testbed.raw_candidates(spark, d))
    return out.select("pos", "reason", "detail", F.array_join("fields", "|").alias("fields"), "year", "episodes", F.md5(F.array_join("synonyms", "|")).alias("synonyms_md5"))


def rejections(spark, d):
    return I.rejection_summary(I.validate(testbed.candidates(spark, d)))


def batches(spark, d):
    """All candidates in four consecutive batches, each resumed at the offset the last one gave."""
    cands = testbed.candidates(spark, d).select("pos", "title")
    size, offset, parts = -(-cands.count() // 4), 0, []
    for i in range(4):
        rows, offset = I.slice_candidates(cands, offset, max(size, 1))
        parts.append(rows.withColumn("batch", F.lit(i)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("batch").agg(F.count("*").alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"))


def release(spark, d):
    out = I.normalize_release(I.validate(testbed.candidates(spark, d)).where("reason is null"))
    return out.select("pos", "entity_id", "canonical_source", "title", F.md5("original_title").alias("original_md5"), "media_type", "release_year", F.array_join("sources", "|").alias("sources"), F.array_join(F.transform("related", lambda r: r["target"]), "|").alias("related"), F.array_join(F.map_keys("field_sources"), "|").alias("lineage"))


def shows(spark, d):
    s = testbed.table(spark, d, "supplier").selectExpr("s_suppkey id", "concat('https://www.tvmaze.com/shows/', s_suppkey) url", "s_name name", "if(s_nationkey % 4 = 0, null, 'Scripted Show') type", "if(s_nationkey % 3 = 0, ' ', 'English') language", "array('Drama', 'Science Fiction', ' ') genres", "if(s_nationkey % 5 = 0, null, 'Ended') status", "if(s_nationkey % 6 = 0, 'soon', concat(1990 + s_nationkey, '-01-02')) premiered",
                                                       "if(s_nationkey % 2 = 0, concat('https://x.example/', s_suppkey), null) official_site", "if(s_nationkey % 7 = 0, null, concat('tt', s_suppkey)) imdb", "cast(if(s_nationkey % 3 = 1, s_suppkey, null) as int) tvdb", "concat('Net ', s_nationkey) network", "if(s_nationkey % 8 = 0, 'Web One', '') web_channel", "cast(s_nationkey % 9 as int) episodes")
    return _join(I.normalize_shows(s), "sources", "tags")


def movies(spark, d):
    m = testbed.table(spark, d, "customer").selectExpr("concat('Q', c_custkey) qid", "c_name label", "if(c_nationkey = 3, null, if(c_nationkey = 4, '1999', concat(1950 + c_nationkey, '-05-06T00:00:00Z'))) publication_date", "if(c_nationkey % 2 = 0, concat('tt', c_custkey), null) imdb_id", "array(c_mktsegment, 'War Film') genres", "array(concat('Director ', c_nationkey)) directors", "array(concat('Series ', c_nationkey)) series")
    return _join(I.normalize_movies(m), "sources", "creators", "tags")


def rollup(spark, d):
    li, p = testbed.table(spark, d, "lineitem"), testbed.table(spark, d, "part")
    b = li.join(p, li.l_partkey == p.p_partkey).selectExpr("concat('Q', l_suppkey) qid", "p_name label", "date_format(l_shipdate, 'yyyy-MM-dd') publication_date", "p_size runtime", "p_type genre", "p_brand director")
    return I.movie_rollup(b)


def canonical(spark, d):
    ents = testbed.shows(spark, d).select(F.substring_index("entity_id", ":", -1).cast("long").alias("pos"), "entity_id", "canonical_source", F.array(F.concat(F.lit("https://anilist.co/anime/"), F.substring_index("entity_id", ":", -1))).alias("sources"))
    ends = F.array(F.struct("pos", "target_entity_id"), F.struct((F.col("pos") + 1_000_000).alias("pos"), F.concat(F.lit("anime:anilist:"), "pos").alias("target_entity_id")))
    edges = testbed.edges(spark, d).withColumn("end", F.explode(ends)).select("source_entity_id", "end.pos", "end.target_entity_id", F.lit("related_anime").alias("relationship"), "target_url", "supporting_urls")
    out = I.canonicalize_targets(edges, ents)
    return out.select("source_entity_id", "target_entity_id", "relationship", "target_url", F.array_join("supporting_urls", "|").alias("supporting_urls"))


def _feed(spark, d):
    kinds = F.array(*[F.lit(x) for x in ("SEQUEL", "PREQUEL", "SPIN_OFF", "SUMMARY", "PARENT", "CONTAINS", "ALTERNATIVE")])
    return testbed.table(spark, d, "lineitem").select(F.concat(F.lit("anime:part:"), "l_partkey").alias("source_entity_id"), F.concat(F.lit("tv:tvmaze:"), "l_suppkey").alias("target_entity_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"), F.element_at(kinds, F.col("l_linenumber")).alias("relation_type"), F.when(F.col("l_linestatus") == "F", "MOVIE").otherwise("OVA").alias("target_format"), F.array(F.lit("https://anilist.co/anime/1"), F.concat(F.lit("https://anilist.co/anime/"), "l_suppkey")).alias("urls"))


def relations(spark, d):
    feed = _feed(spark, d).dropDuplicates(["source_entity_id", "target_entity_id", "pos"])
    out = I.enrich_relations(testbed.edges(spark, d), feed)
    return out.select("source_entity_id", "target_entity_id", "relationship", F.array_join("supporting_urls", "|").alias("supporting_urls"))


def metadata(spark, d):
    feed = testbed.table(spark, d, "part").select(F.concat(F.lit("https://anidb.net/anime/"), "p_partkey").alias("canonical_source"), F.when(F.col("p_size") % 2 == 0, F.array(F.lit("Feed"), F.col("p_type"))).otherwise(F.array().cast("array<string>")).alias("genres"), F.when(F.col("p_size") % 3 == 0, F.array(F.lit("Studio"))).otherwise(F.lit(None)).alias("studios"), F.array("p_name").alias("creators"))
    out = I.enrich_metadata(testbed.anime(spark, d), feed, "canonical_source")
    return out.select("entity_id", *[F.array_join(c, "|").alias(c) for c in ("genres", "studios", "creators")], F.array_join(F.array_sort(F.map_keys("field_sources")), "|").alias("lineage"))


def request_ids(spark, d):
    return I.first_requests(testbed.table(spark, d, "events"), "user_id", "event_id")


_REASONS = """with r as (select *, case when title is null then 'missing_required_field' when "type" = 'CLIP' then 'missing_required_field' when "year" is null then 'missing_required_field' when unsupported then 'unsupported_source_url' end reason,
 case when title is null then 'title' when "type" = 'CLIP' then 'candidate_shape' when "year" is null then 'animeSeason.year' when unsupported then 'sources' end detail from v_cand) """
_TARGET = "['SEQUEL', 'PREQUEL', 'SPIN_OFF', 'SUMMARY', 'PARENT', 'CONTAINS', 'ALTERNATIVE'][l_linenumber]"

CASES = {
    "f_title_contains": (filtered_titles, duck("select entity_id, title from v_ent where contains(lower(title), 'red')", "v_ent")),
    "f_validate": (validated, duck(_REASONS + "select pos, reason, detail from r", "v_cand")),
    "f_validate_raw": (validated_raw, """with c as (select doc_id pos, text, n_chars, case when doc_id % 11 in (2, 8) then 'missing' when doc_id % 11 in (1, 3, 4, 6, 7, 10) then 'odd' when n_chars % 7 = 0 then 'year' when doc_id % 9 = 0 then 'sources' end r from documents where doc_id is not null)
 select pos, case when r = 'sources' then 'unsupported_source_url' when r is not null then 'missing_required_field' end reason, case when r = 'missing' then case pos % 11 when 2 then 'title' else 'title,type' end when r = 'odd' then 'candidate_shape' when r = 'year' then 'animeSeason.year' else r end detail,
 case when r = 'odd' then case pos % 11 when 1 then 'title' when 3 then 'type' when 4 then 'episodes' when 6 then 'animeSeason.season|animeSeason.year' when 7 then 'synonyms.1' else '' end when r = 'missing' then case pos % 11 when 2 then 'title' else 'title|type' end when r = 'year' then 'animeSeason.year' else r end fields,
 case when r is null or r = 'sources' then (1950 + n_chars % 70)::int end "year", case when (r is null or r in ('year', 'sources')) and pos % 11 <> 5 then (n_chars % 26)::int end episodes, case when r is null or r in ('year', 'sources') then md5(text) end synonyms_md5 from c"""),
    "f_rejections": (rejections, duck(_REASONS + "select coalesce(reason, 'accepted') reason, count(*) n from r group by 1", "v_cand")),
    "f_batches": (batches, "with o as (select doc_id, row_number() over (order by doc_id) - 1 i, count(*) over () n from documents), b as (select i // ((n + 3) // 4) batch, doc_id from o) select batch::int batch, count(*) n, min(doc_id) low, max(doc_id) high from b group by 1"),
    "n_release": (release, duck(_REASONS + """select pos, 'anime:anidb:'||pos entity_id, 'https://anidb.net/anime/'||pos canonical_source, title, case when regexp_matches(text, '[^\\x00-\\x7F]') then md5(text) end original_md5, "type" media_type, "year" release_year,
 'https://myanimelist.net/anime/'||pos||'/x|https://anidb.net/anime/'||pos||'|https://kitsu.app/anime/a-b' sources, 'anime:anilist:'||(pos + 1) related, 'title|episodes|status|release_year' lineage from r where reason is null""", "v_cand")),
    "n_shows": (shows, """select 'tv:tvmaze:'||s_suppkey entity_id, 'tv' as domain, s_name title, case when s_nationkey % 4 = 0 then 'TV' else 'Scripted Show' end media_type, case when s_nationkey % 5 = 0 then 'UNKNOWN' else 'Ended' end status, case when s_nationkey % 6 = 0 then 0 else 1990 + s_nationkey end release_year, nullif(s_nationkey % 9, 0) episodes,
 array_to_string(list_sort(list_filter(['https://www.tvmaze.com/shows/'||s_suppkey, case when s_nationkey % 2 = 0 then 'https://x.example/'||s_suppkey end, case when s_nationkey % 7 <> 0 then 'https://www.imdb.com/title/tt'||s_suppkey||'/' end, case when s_nationkey % 3 = 1 then 'https://thetvdb.com/series/'||s_suppkey end], lambda x: x is not null)), '|') sources,
 array_to_string(list_sort(list_filter(['drama', 'science_fiction', case when s_nationkey % 3 <> 0 then 'language:english' end, 'network:'||case when s_nationkey % 8 = 0 then 'web_one' else 'net_'||s_nationkey end, case when s_nationkey % 4 <> 0 then 'tv_type:scripted_show' end], lambda x: x is not null)), '|') tags from supplier"""),
    "n_movies": (movies, """select 'movie:wikidata:Q'||c_custkey entity_id, 'movie' as domain, c_name title, 'MOVIE' media_type, case when c_nationkey = 3 then 'UNKNOWN' else 'RELEASED' end status, case c_nationkey when 3 then 0 when 4 then 1999 else 1950 + c_nationkey end release_year,
 case when c_nationkey % 2 = 0 then 'https://www.imdb.com/title/tt'||c_custkey||'/|' else '' end||'https://www.wikidata.org/wiki/Q'||c_custkey sources, 'Director '||c_nationkey creators, array_to_string(list_sort([lower(c_mktsegment), 'war_film', 'franchise:series_'||c_nationkey]), '|') tags from customer"""),
    "a_movie_rollup": (rollup, "select 'Q'||l_suppkey qid, min(p_name) label, strftime(min(l_shipdate), '%Y-%m-%d') publication_date, min(p_size) runtime, string_agg(distinct p_type, '|' order by p_type) genres, string_agg(distinct p_brand, '|' order by p_brand) directors from lineitem join part on l_partkey = p_partkey group by l_suppkey"),
    "j_canonical_targets": (canonical, duck("select source_entity_id, target_entity_id, 'related_anime' relationship, 'https://www.tvmaze.com/shows/'||pos target_url, array_to_string(supporting_urls, '|')||'|https://www.tvmaze.com/shows/'||pos supporting_urls from v_edge", "v_edge")),
    "j_enrich_relations": (relations, duck(f"""with f as (select l_partkey k, l_suppkey s, arg_max({_TARGET}, l_orderkey * 10 + l_linenumber) t, arg_max(l_linestatus, (l_orderkey * 10 + l_linenumber, l_linestatus)) st from lineitem group by all), g as (select *, case t when 'SEQUEL' then 'sequel' when 'PREQUEL' then 'prequel' when 'SPIN_OFF' then 'spinoff' when 'SUMMARY' then 'recap' when 'PARENT' then case st when 'F' then 'movie_tie_in' else 'special' end when 'CONTAINS' then case st when 'F' then 'movie_tie_in' else 'special' end end nt from f)
 select source_entity_id, target_entity_id, case when relationship = 'related_anime' and nt is not null then nt else relationship end relationship, array_to_string(supporting_urls, '|')||case when relationship = 'related_anime' and nt is not null then case when list_contains(supporting_urls, 'https://anilist.co/anime/1') then '' else '|https://anilist.co/anime/1' end||case when pos = 1 or list_contains(supporting_urls, 'https://anilist.co/anime/'||pos) then '' else '|https://anilist.co/anime/'||pos end else '' end supporting_urls from v_edge join g on g.k = v_edge.k and g.s = pos""", "v_edge")),
    "j_enrich_metadata": (metadata, "select 'anime:part:'||p_partkey entity_id, case when p_size % 2 = 0 then 'Feed|'||p_type else p_type end genres, case when p_size % 3 = 0 then 'Studio' else p_brand end studios, p_name creators, 'creators'||case when p_size % 2 = 0 then '|genres' else '' end||'|status'||case when p_size % 3 = 0 then '|studios' else '' end||'|title' lineage from part"),
    "n_request_ids": (request_ids, "select user_id, min(event_id) first_at from events group by 1"),
}
