"""Queries for search, families, sections, neighbours, concepts and similarity."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.operators import search as S
from marquee.operators import tables as B
from marquee.plans import fixed, testbed
from marquee.plans.testbed import duck

#: The stated query set.
TEXTS = ["small ring", "red", "widget  BLUE", "Été", "brand#2", "Customer#000000001", "gear"]
CONCEPTS = ["romance in college", "Action/adventure for adults", "slice of life", "drama"]


def folder(spark):
    """``spark.checkpoint.dir``, which driver and executors share; a local session without one gets its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        shared = f"file:///tmp/checkpoints/{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def _texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "query string")


def _hits(spark, d):
    return S.search(testbed.entities(spark, d), _texts(spark))


def title_matches(spark, d):
    return _hits(spark, d).groupBy("query", "score", F.array_join("matched_fields", "|").alias("fields")).agg(F.count("*").alias("n"))


def title_search(spark, d):
    return S.top(_hits(spark, d), S.search_order(), 10, ["query"]).select("query", "rank", "entity_id", "score", F.array_join("matched_fields", "|").alias("fields"))


def resolve_title(spark, d):
    anime = testbed.anime(spark, d)
    return S.resolve_title(anime, anime.select("entity_id", "episodes"), _texts(spark)).select("query", "entity_id", "episodes")


def families(spark, d):
    return S.families(testbed.graph(spark, d), folder(spark))


def _both_ways(spark, d):
    edges = testbed.edges(spark, d)
    rest = ("target_url", "supporting_urls")
    out = F.struct("source_entity_id", "pos", "target_entity_id", "relationship", *rest)
    back = F.struct(F.col("target_entity_id").alias("source_entity_id"), "pos", F.col("source_entity_id").alias("target_entity_id"), F.lit("sequel").alias("relationship"), *rest)
    return edges.select(F.explode(F.array(out, back)).alias("e")).select("e.*")


def incoming(spark, d):
    return S.incoming(_both_ways(spark, d)).groupBy("target_entity_id", "relationship", "direction").agg(F.count("*").alias("n"))


def sections(spark, d):
    return S.related_sections(testbed.entities(spark, d), _both_ways(spark, d))


def family_graph(spark, d):
    pairs = testbed.graph(spark, d)
    members = S.families(pairs, folder(spark))
    edges = pairs.select(F.col("src").alias("source_entity_id"), F.lit(0).alias("pos"), F.col("dst").alias("target_entity_id"), F.lit("sequel").alias("relationship"), F.concat(F.lit("https://anilist.co/anime/"), "dst").alias("target_url"), F.array().cast("array<string>").alias("supporting_urls"))
    nodes, inside = S.family_graph(testbed.anime(spark, d), edges, members)
    n = nodes.groupBy("family").agg(F.count("*").alias("node_count"))
    return n.join(inside.groupBy("family").agg(F.count("*").alias("edge_count"), F.sum("confidence").alias("confidence")), "family")


def _roots(spark, d):
    return title_search(spark, d).where("rank = 1 and entity_id like 'anime:%'").select("entity_id").distinct()


def shared_studios(spark, d):
    return S.shared_metadata(testbed.anime(spark, d), "studios", "same_studio", _roots(spark, d), S.families(testbed.graph(spark, d), folder(spark)))


def shared_creators(spark, d):
    return S.shared_metadata(testbed.anime(spark, d), "creators", "same_creator", _roots(spark, d), S.families(testbed.graph(spark, d), folder(spark)))


def tag_neighbours(spark, d):
    return S.tag_neighbours(testbed.anime(spark, d), _roots(spark, d), 20)


def concept_parse(spark, d):
    t = testbed.table(spark, d, "documents").select("doc_id", S.parse_concept(F.concat_ws(" ", "text", F.when(F.col("doc_id") % 3 == 0, "Romance/University"), F.when(F.col("doc_id") % 4 == 0, "slice of  life"))).alias("c"))
    return t.select("doc_id", *[F.array_join(f"c.{k}", "|").alias(k) for k in ("genres", "tags", "notes")])


def _concept_entities(spark, d):
    genres = F.array(*[F.lit(g) for g in fixed.GENRE_WORDS.values()])
    return testbed.anime(spark, d).withColumn("tags", F.when(F.col("release_year") > 2015, F.array_append("tags", F.lit("COLLEGE"))).otherwise(F.col("tags"))).withColumn("genres", F.array(F.element_at(genres, (F.col("episodes") % 7 + 1).cast("int"))))


def concept_search(spark, d):
    queries = spark.createDataFrame([(q,) for q in CONCEPTS], "query string")
    return S.concept_search(_concept_entities(spark, d), queries).drop("title", "release_year")


def concept_top(spark, d):
    queries = spark.createDataFrame([(q,) for q in CONCEPTS], "query string")
    return S.top(S.concept_search(_concept_entities(spark, d), queries), S.concept_order(), 10, ["query"]).select("query", "rank", "entity_id", "score")


def retrieval(spark, d):
    return S.retrieval_text(testbed.entities(spark, d))


def preview(spark, d):
    """The preview of one text, its arrays as text; of nodes and edges, which may be very many, the digests."""
    frames = S.preview_frames(testbed.entities(spark, d), testbed.edges(spark, d), "small ring", folder(spark), confidence=False)
    joined = lambda *fields: F.concat_ws(":", *[F.col(f).cast("string") for f in fields])
    nodes = S.ordered_digest(frames.pop("nodes"), joined("place", "entity_id"), "place", "node")
    edges = S.ordered_digest(frames.pop("edges"), joined("source_entity_id", "relationship", "target_entity_id"), "place", "edge")
    out = S.beside(S.beside(S.preview_row(frames), nodes), edges)
    text = lambda column, *fields: F.array_join(F.transform(column, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), "|")
    hundredths = lambda x, f: F.round(x[f] * 100).cast("long").cast("string")
    return out.select(
        "query", "selected_entity_id", text("matches", "rank", "entity_id", "score").alias("matches"), "node_count", "nodes_md5", "edge_count", "edges_md5",
        F.array_join(F.transform("sections", lambda x: F.concat_ws(":", x["relationship"], x["place"].cast("string"), x["other_id"], hundredths(x, "confidence"))), "|").alias("sections"),
        F.array_join(F.transform("tag_neighbours", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["other_id"], x["overlap"].cast("string"), hundredths(x, "score"))), "|").alias("tag_neighbours"),
    )


def preview_nodes(spark, d):
    """Nodes of the preview's family as a frame of their own."""
    return S.preview_frames(testbed.entities(spark, d), testbed.edges(spark, d), "small ring", folder(spark), wanted=("nodes",))["nodes"]


def preview_edges(spark, d):
    frames = S.preview_frames(testbed.entities(spark, d), testbed.edges(spark, d), "small ring", folder(spark), wanted=("edges",))
    return frames["edges"].select("place", "source_entity_id", "relationship", "target_entity_id", "confidence")


def title_lookup(spark, d):
    """As many queries as customers: their names, or all but the last letter of them in capitals. The first three hits of each."""
    k = F.col("c_custkey")
    queries = testbed.table(spark, d, "customer").select(F.when(k % 2 == 0, F.col("c_name")).otherwise(F.upper(F.left("c_name", F.length("c_name") - 1))).alias("query"))
    return S.top(S.search(testbed.entities(spark, d), queries), S.search_order(), 3, ["query"]).select("query", "rank", "entity_id", "score", F.array_join("matched_fields", "|").alias("fields"))


def franchise_pairs(spark, d):
    return S.franchise_pairs(testbed.movies(spark, d))


def exclude_family(spark, d):
    return S.exclude_family(testbed.anime(spark, d), S.families(testbed.graph(spark, d), folder(spark))).select("entity_id", "title")


def neighbours_with_evidence(spark, d):
    """Evidence of every third edge is withheld, so some edges stay without."""
    ents, edges = testbed.entities(spark, d), testbed.edges(spark, d)
    evidence = B.relationship_evidence_table(edges, ents).where("try_cast(substring_index(source_record_id, ':', -1) as long) % 3 <> 0")
    out = S.neighbours_with_evidence(B.relationships_table(edges, ents), evidence)
    return out.groupBy("relationship_type", "has_evidence", "evidence_strength").agg(F.count("*").alias("n"), F.countDistinct("source_entity_id").alias("sources"), F.max("claim").alias("claim"))


def similar_vectors(spark, d):
    """Every vector whose id is divisible by 20 against all vectors: the five nearest of each label."""
    return S.nearest_vectors(testbed.table(spark, d, "embeddings"), per="label").withColumnRenamed("name", "label")


def nearest_vectors(spark, d):
    """The same queries against all vectors, whatever their label."""
    return S.nearest_vectors(testbed.table(spark, d, "embeddings"))


def similarity(spark, d):
    """Roots are the best hits of the stated texts; the nearest vectors stand for parts of the same number."""
    near = nearest_vectors(spark, d).select(F.concat(F.lit("anime:part:"), "query_id").alias("entity_id"), F.concat(F.lit("anime:part:"), "vec_id").alias("other_id"), "score")
    roots = _roots(spark, d).unionByName(near.select("entity_id").distinct().orderBy("entity_id").limit(5)).distinct()
    out = S.similarity_candidates(testbed.anime(spark, d), testbed.edges(spark, d), roots, near)
    value = lambda k: F.round(F.coalesce(F.try_element_at("score_dimensions", F.lit(k)), F.lit(0.0)), 6)
    return out.select("source_entity_id", "target_entity_id", F.array_join("candidate_reasons", "|").alias("reasons"), value("shared_facets").alias("shared"), value("graph_distance_2").alias("via"), value("vector_neighbour").alias("vector"), "confidence_tier")


def embedded(spark, d):
    """Every text but those of every third document, which an earlier run embedded."""
    docs = testbed.table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    before = S.embed(docs.where("doc_id % 3 = 0"), spark.createDataFrame([], "cache_key string"), "doc_id", "text")
    return S.embed(docs, before, "doc_id", "text").select("doc_id", F.array_join(F.transform("vector", lambda v: F.round((v + 1) * 255 / 2).cast("int").cast("string")), ",").alias("bytes"))


def refusing_model():
    """A model that gives hash vectors, and fails for a list with a text whose length is divisible by 11."""
    import hashlib

    def call(texts):
        if any(len(t) % 11 == 0 for t in texts):
            raise ValueError("refused")
        return [[b / 255 * 2 - 1 for b in hashlib.sha256(t.encode()).digest()[:8]] for t in texts]

    return call


def embedded_by_model(spark, d):
    """The same texts through the hook for real models; refused ones come as errors."""
    docs = testbed.table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    names = ("deterministic", "sha256", "embedding-v1")
    before = S.fresh_texts(docs.where("doc_id % 3 = 0"), spark.createDataFrame([], "cache_key string"), "doc_id", "text", *names)
    out = S.embed_batches(docs, before, "doc_id", "text", refusing_model, *names)
    return out.select("doc_id", F.array_join(F.transform("vector", lambda v: F.round((v + 1) * 255 / 2).cast("int").cast("string")), ",").alias("bytes"), "error")


def concept_remote(spark, d):
    """Documents as remote results, in their order, the first ten of each language."""
    tags = F.array(F.struct(F.lit("College").alias("name"), (F.col("n_chars") % 90).cast("int").alias("rank")), F.struct(F.lit("School").alias("name"), F.lit(50).alias("rank")))
    genres = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("Romance"), F.lit("Drama"))).otherwise(F.array(F.lit("Drama")))
    media = testbed.table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("pos"), "lang", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("t"), "doc_id")).alias("romaji"), F.lit(None).cast("string").alias("english"), F.lit("n").alias("native"), genres.alias("genres"), F.when(F.col("doc_id") % 3 == 0, tags).otherwise(F.slice(tags, 2, 1)).alias("tags"), F.array(F.lit("Romance")).alias("wanted_genres"), F.array(F.lit("College")).alias("wanted_tags"), (F.col("n_chars") % 7 * 10).cast("int").alias("score"))
    ranked = S.concept_rank(media).join(media.select("id", "lang"), "id")
    return S.top(ranked, S.concept_rank_order(), 10, ["lang"]).select("lang", "rank", "id", "title", "strength", "rationale")


_FOLD = "trim(regexp_replace(replace(lower({}), 'ß', 'ss'), '\\s+', ' ', 'g'))"
_Q = "q as (select query, " + _FOLD.format("query") + " q from (values " + ", ".join(f"('{t}')" for t in TEXTS) + ") t(query))"
_NAMES = f"""n as (select entity_id, title, release_year, 1 o, 'title' f, {_FOLD.format("title")} name from v_ent union all select entity_id, title, release_year, 2, 'original_title', {_FOLD.format("original_title")} from v_ent where original_title is not null union all select entity_id, title, release_year, 3, 'synonym', {_FOLD.format("s")} from (select *, unnest(synonyms) s from v_ent))"""
_HITS = f"""with {_Q}, {_NAMES}, s as (select query, entity_id, title, release_year, o, f, case when name = q then case when o = 1 then 100 else 96 end when starts_with(name, q) then case when o = 1 then 92 else 84 end when contains(name, q) then case when o = 1 then 88 else 80 end
 else case when len(list_intersect(string_split(q, ' '), string_split(name, ' '))) > 0 then 60 + least(4 * len(list_intersect(string_split(q, ' '), string_split(name, ' '))), 16) else 0 end end score from n cross join q), b as (select *, max(score) over (partition by query, entity_id) best from s),
 h as (select query, entity_id, any_value(title) title, any_value(release_year) release_year, best::int score, string_agg(distinct f, '|' order by f desc) fields0, max(o) filter (o = 1) a1, max(o) filter (o = 2) a2, max(o) filter (o = 3) a3 from b where score = best and best > 0 group by query, entity_id, best),
 m as (select query, entity_id, title, release_year, score, concat_ws('|', case when a1 is not null then 'title' end, case when a2 is not null then 'original_title' end, case when a3 is not null then 'synonym' end) fields from h),
 t as (select *, row_number() over (partition by query order by score desc, release_year, {_FOLD.format("title")}, entity_id) "rank" from m) """
_FAM = """p as (select p_partkey k, p_size, lag(p_size) over (order by p_partkey) l from part), i as (select k, sum(case when l is null or abs(l - p_size) >= 20 then 1 else 0 end) over (order by k) g from p), fm as (select 'anime:part:'||k node, min('anime:part:'||k) over (partition by g) family, count(*) over (partition by g) size, k, g from i) """
_BOTH = "bw as (select source_entity_id s, target_entity_id t, relationship r, pos, target_url, supporting_urls from v_edge union all select target_entity_id, source_entity_id, 'sequel', pos, target_url, supporting_urls from v_edge)"
_BASE = "case relationship " + " ".join(f"when '{r}' then {v}::double" for r, v in fixed.BASE_CONFIDENCE.items()) + " else 0.4::double end"
_CONF = """round(least(case r when 'related_anime' then 0.42::double else 0.78::double end + least(len(supporting_urls) - 1, 5) * 0.04::double + least(len(list_distinct(list_transform(supporting_urls, lambda u: regexp_extract(u, '//([^/]+)/', 1)))) - 1, 4) * 0.05::double + case when r <> 'related_anime' and len(list_filter(supporting_urls, lambda u: u like 'https://anilist.co/%')) > 0 then 0.06::double else 0 end, 0.98), 2)"""
_SECTIONS = f"""with {_BOTH}, c as (select s e, t o, r, pos, 'outgoing' dir, {_CONF} conf from bw union all select t, s, r, pos, 'incoming', {_CONF} from bw), k as (select e, o, r, row_number() over (partition by e, o, r order by (dir = 'outgoing') desc, case when dir = 'outgoing' then -pos else pos end) i, count(distinct dir) over (partition by e, o, r) nd, dir, conf from c),
 z as (select e entity_id, r relationship, o other_id, case when nd > 1 then 'bidirectional' else dir end direction, conf confidence, title, release_year from k join v_ent on entity_id = o where i = 1) select entity_id, relationship, row_number() over (partition by entity_id, relationship order by confidence desc, release_year, {_FOLD.format("title")}, other_id) place, other_id, direction, confidence from z"""
_ROOTS = _HITS + f", {_FAM}, ro as (select distinct entity_id from t where \"rank\" = 1 and entity_id like 'anime:%') "


def _shared(column: str, relationship: str) -> str:
    return _ROOTS + f""", x as (select ro.entity_id, b.entity_id other_id, b.title, b.release_year, len(list_intersect(list_transform(a.{column}, lambda v: lower(v)), list_transform(b.{column}, lambda v: lower(v)))) overlap from ro join v_anime a on a.entity_id = ro.entity_id join v_anime b on b.entity_id <> a.entity_id join fm f on f.node = a.entity_id join fm g on g.node = b.entity_id where (f.family <> g.family or f.size = 1 or g.size = 1) and overlap > 0)
 select entity_id, '{relationship}' relationship, row_number() over (partition by entity_id order by overlap desc, release_year, {_FOLD.format("title")}, other_id) place, other_id, overlap, {fixed.BASE_CONFIDENCE[relationship]}::double confidence from x"""


_TAGS = _ROOTS + f""", x as (select ro.entity_id, b.entity_id other_id, b.title, b.release_year, len(list_intersect(a.tags, b.tags)) n, len(list_distinct(list_concat(a.tags, b.tags))) u from ro join v_anime a on a.entity_id = ro.entity_id join v_anime b on b.entity_id <> a.entity_id), y as (select *, ((200 * n * (u + 1) + u) // (2 * u)) / 100.0::double score from x where n > 0),
 z as (select entity_id, other_id, n overlap, score, row_number() over (partition by entity_id order by score desc, n desc, release_year, {_FOLD.format("title")}, other_id) "rank" from y) select * from z where "rank" <= 20"""
_TEXT = _FOLD.format("replace(concat_ws(' ', text, case when doc_id % 3 = 0 then 'Romance/University' end, case when doc_id % 4 = 0 then 'slice of  life' end), '/', ' ')")
_PARSE = f"""with f as (select doc_id, {_TEXT} t from documents), g as (select doc_id, contains(t, 'college') or contains(t, 'university') u, contains(t, 'adult') a, contains(t, 'romance') r, concat_ws('|', """ + ", ".join(f"case when contains(t, '{w}') then '{g}' end" for w, g in fixed.GENRE_WORDS.items()) + """) genres from f) select doc_id, genres, case when u then 'College|Primarily Adult Cast' when a then 'Primarily Adult Cast' else '' end tags, concat_ws('|', case when u then 'mapped university/college language to AniList College + Primarily Adult Cast tags' end, case when r then 'mapped romance language to AniList Romance genre' end) notes from g"""
_CONCEPTS = """with q(query, genres, tags) as (values ('romance in college', ['Romance'], ['College', 'Primarily Adult Cast']), ('Action/adventure for adults', ['Action', 'Adventure'], ['Primarily Adult Cast']), ('slice of life', ['Slice of Life'], cast([] as varchar[])), ('drama', ['Drama'], cast([] as varchar[]))),
 e as (select entity_id, title, release_year, ['Action', 'Adventure', 'Comedy', 'Drama', 'Fantasy', 'Romance', 'Slice of Life'][episodes % 7 + 1] g, case when release_year > 2015 then list_append(tags, 'COLLEGE') else tags end tg from v_anime),
 m as (select query, entity_id, title, release_year, list_contains(genres, g) hg, list_contains(q.tags, 'College') and list_contains(tg, 'COLLEGE') ht, len(q.tags) wanted, g, least(len(tg), 20) nt from q cross join e),
 c as (select query, entity_id, title, release_year, round(hg::int * 3.0::double + ht::int * 2.0::double + nt * 0.01::double + case when hg and ht then 0.5::double else 0 end, 2) score, ht::int n_tags, concat_ws('; ', case when hg then 'genre match: '||g end, case when ht then 'tag match: College' end) rationale from m where (hg or ht) and (wanted = 0 or ht)) """

_PREVIEW = _HITS + f""", ro as (select entity_id r from t where query = 'small ring' and "rank" = 1), bw2 as (select source_entity_id s, target_entity_id o from v_edge union select target_entity_id, source_entity_id from v_edge),
 fam(x) as (select r from ro union select o from fam join bw2 on s = x), nd as (select v_ent.*, row_number() over (order by domain, release_year, {_FOLD.format("title")}, entity_id) place from v_ent semi join fam on x = entity_id),
 ed as (select source_entity_id s, relationship r, target_entity_id o from v_edge where source_entity_id in (select entity_id from nd) and target_entity_id in (select x from fam)),
 ee as (select source_entity_id e, target_entity_id o, relationship r, supporting_urls from v_edge join ro on r = source_entity_id), e2 as (select e, o, r, {_CONF} conf from ee),
 se as (select r, row_number() over (partition by r order by conf desc, release_year, {_FOLD.format("title")}, o) p, o, round(conf * 100)::bigint c from e2 join v_ent on entity_id = o),
 sh as (select k r, row_number() over (partition by k order by n desc, release_year, {_FOLD.format("title")}, entity_id) p, entity_id o, c from (select 'same_studio' k, {round(100 * fixed.BASE_CONFIDENCE["same_studio"])}::bigint c, len(list_intersect(list_transform(a.studios, lambda v: lower(v)), list_transform(b.studios, lambda v: lower(v)))) n, b.* from v_ent a join ro on a.entity_id = r join v_ent b on b.entity_id <> r and b.entity_id not in (select x from fam)
  union all select 'same_creator', {round(100 * fixed.BASE_CONFIDENCE["same_creator"])}, len(list_intersect(a.creators, b.creators)), b.* from v_ent a join ro on a.entity_id = r join v_ent b on b.entity_id <> r and b.entity_id not in (select x from fam)) where n > 0),
 tx as (select b.entity_id, b.title, b.release_year, len(list_intersect(a.tags, b.tags)) n, len(list_distinct(list_concat(a.tags, b.tags))) u from v_ent a join ro on a.entity_id = r join v_ent b on b.entity_id <> r and b.entity_id not in (select x from fam)),
 ty as (select *, (200 * n * (u + 1) + u) // (2 * u) sc from tx where n > 0), tz as (select *, row_number() over (order by sc desc, n desc, release_year, {_FOLD.format("title")}, entity_id) p from ty)
 select 'small ring' query, (select r from ro) selected_entity_id, (select string_agg("rank"||':'||entity_id||':'||score, '|' order by "rank") from t where query = 'small ring' and "rank" <= 5) matches, (select count(*)::int from nd) node_count, (select md5(string_agg(place||':'||entity_id, '|' order by place)) from nd) nodes_md5,
 (select count(*)::int from ed) edge_count, (select md5(coalesce(string_agg(s||':'||r||':'||o, '|' order by s, r, o), '')) from ed) edges_md5, (select coalesce(string_agg(r||':'||p||':'||o||':'||c, '|' order by r, p), '') from (select * from se union all select * from sh)) sections,
 (select coalesce(string_agg(p||':'||entity_id||':'||n||':'||sc, '|' order by p), '') from tz where p <= 5) tag_neighbours"""
_NEAR = "nv as (select query_id q, vec_id v, score sc from (select *, row_number() over (partition by query_id order by score desc, vec_id) k from (select a.vec_id query_id, b.vec_id, round(list_dot_product(a.embedding::double[], b.embedding::double[]), 6) score from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0)) where k <= 5)"
_SIMILAR = _HITS + f""", {_NEAR}, ro as (select entity_id r from t where "rank" = 1 and entity_id like 'anime:%' union select * from (select distinct 'anime:part:'||q r from nv order by r limit 5)),
 fx as (select entity_id e, 'tags' k, lower(trim(v)) v from (select entity_id, unnest(tags) v from v_anime) union select entity_id, 'genres', lower(trim(v)) from (select entity_id, unnest(genres) v from v_anime) union select entity_id, 'studios', lower(trim(v)) from (select entity_id, unnest(studios) v from v_anime) union select entity_id, 'creators', lower(trim(v)) from (select entity_id, unnest(creators) v from v_anime)),
 sf as (select a.e, b.e o, count(*)::double n from fx a join ro on a.e = r join fx b on a.k = b.k and a.v = b.v and a.e <> b.e group by 1, 2), b2 as (select source_entity_id s, target_entity_id o from v_edge union select target_entity_id, source_entity_id from v_edge),
 th as (select a.s e, b.o, count(*)::double n from b2 a join ro on a.s = r join b2 b on b.s = a.o and b.o <> a.s where not exists (select 1 from b2 c where c.s = a.s and c.o = b.o) group by 1, 2), vn as (select 'anime:part:'||q e, 'anime:part:'||v o, sc n from nv join ro on r = 'anime:part:'||q),
 al as (select e, o, 'shared_facets' k, n from sf union all select e, o, 'graph_distance_2', n from th union all select e, o, 'vector_neighbour', n from vn)
 select e source_entity_id, o target_entity_id, string_agg(k, '|' order by k) reasons, coalesce(max(n) filter (k = 'shared_facets'), 0.0) shared, coalesce(max(n) filter (k = 'graph_distance_2'), 0.0) via, coalesce(max(n) filter (k = 'vector_neighbour'), 0.0) vector, case when count(*) > 1 then 'medium' else 'low' end confidence_tier from al group by 1, 2"""
_EVIDENCE = "with t(relationship) as (values " + ", ".join(f"('{r}')" for r, *_ in fixed.TAXONOMY) + """), e as (select *, k % 3 <> 0 has from v_edge semi join v_ent on entity_id = source_entity_id semi join t using (relationship)) select relationship relationship_type, has has_evidence, case when has then 'source_backed' end evidence_strength, count(*) n, count(distinct source_entity_id) sources, max(case when has then relationship end) claim from e group by 1, 2, 3"""
_REMOTE = """with m as (select doc_id id, lang, case when doc_id % 5 = 0 then 'n' else 't'||doc_id end title, (doc_id % 2 = 0)::int g, (doc_id % 3 = 0)::int t, case when doc_id % 3 = 0 then n_chars % 90 else 0 end strength, n_chars % 7 * 10 score from documents),
 r as (select *, row_number() over (partition by lang order by g desc, t desc, strength desc, score desc, id) "rank" from m) select lang, "rank", id, title, strength, concat_ws('; ', case when g = 1 then 'genre match: Romance' end, case when t = 1 then 'tag match: College' end, 'AniList score '||score) rationale from r where "rank" <= 10"""

CASES = {
    "title_search": (title_search, duck(_HITS + 'select query, "rank", entity_id, score, fields from t where "rank" <= 10', "v_ent")),
    "y_title_matches": (title_matches, duck(_HITS + "select query, score, fields, count(*) n from m group by all", "v_ent")),
    "j_resolve_title": (resolve_title, duck(f"with {_Q} select query, entity_id, episodes from v_anime join q on q = {_FOLD.format('title')}", "v_anime")),
    "y_families": (families, f"with {_FAM} select node, family from fm where size > 1"),
    "j_incoming": (incoming, duck(f"with {_BOTH} select t target_entity_id, r relationship, case when exists (select 1 from bw b where b.s = a.t and b.t = a.s and b.r = a.r) then 'bidirectional' else 'incoming' end direction, count(*) n from bw a group by all", "v_edge")),
    "y_related_sections": (sections, duck(_SECTIONS, "v_ent", "v_edge")),
    "y_family_graph": (family_graph, f"with {_FAM} select family, count(*) node_count, count(*) - 1 edge_count, (count(*) - 1) * 0.78::double confidence from fm where size > 1 group by 1"),
    "y_shared_studios": (shared_studios, duck(_shared("studios", "same_studio"), "v_ent", "v_anime")),
    "y_shared_creators": (shared_creators, duck(_shared("creators", "same_creator"), "v_ent", "v_anime")),
    "y_tag_neighbours": (tag_neighbours, duck(_TAGS, "v_ent", "v_anime")),
    "y_concept_parse": (concept_parse, _PARSE),
    "y_concept_search": (concept_search, duck(_CONCEPTS + "select query, entity_id, score, n_tags, rationale from c", "v_anime")),
    "y_concept_top": (concept_top, duck(_CONCEPTS + f"select * from (select query, row_number() over (partition by query order by score desc, n_tags desc, release_year, {_FOLD.format('title')}, entity_id) \"rank\", entity_id, score from c) where \"rank\" <= 10", "v_anime")),
    "y_retrieval_text": (retrieval, duck("select entity_id, concat_ws(' | ', title, original_title, media_type, status, nullif(release_year, 0)::varchar, nullif(array_to_string(synonyms, ', '), ''), nullif(array_to_string(genres, ', '), ''), nullif(array_to_string(studios, ', '), ''), nullif(array_to_string(creators, ', '), ''), nullif(array_to_string(tags, ', '), '')) retrieval_text from v_ent", "v_ent")),
    "y_query_preview": (preview, duck(_PREVIEW, "v_ent", "v_edge")),
    "y_similarity_candidates": (similarity, duck(_SIMILAR, "v_ent", "v_anime", "v_edge")),
    "y_preview_nodes": (preview_nodes, duck(_PREVIEW[: _PREVIEW.index(" select 'small ring' query")] + " select place, entity_id from nd", "v_ent", "v_edge")),
    "y_preview_edges": (preview_edges, duck(_PREVIEW[: _PREVIEW.index(" select 'small ring' query")] + f" select row_number() over (order by source_entity_id, r, target_entity_id) place, source_entity_id, r relationship, target_entity_id, {_CONF} confidence from (select *, relationship r from v_edge) where source_entity_id in (select entity_id from nd) and target_entity_id in (select x from fam)", "v_ent", "v_edge")),
    "y_title_lookup": (title_lookup, duck(_HITS.replace(_Q, "q as (select *, " + _FOLD.format("query") + " q from (select case when c_custkey % 2 = 0 then c_name else upper(left(c_name, length(c_name) - 1)) end query from customer))") + 'select query, "rank", entity_id, score, fields from t where "rank" <= 3', "v_ent")),
    "y_embed_batches": (embedded_by_model, "select doc_id, case when length(coalesce(text, '')) % 11 <> 0 then array_to_string(list_transform(range(0, 8), lambda i: ('0x'||substr(sha256(coalesce(text, '')), 2 * i + 1, 2))::int), ',') end bytes, case when length(coalesce(text, '')) % 11 = 0 then 'ValueError: refused' end error from documents where coalesce(text, '') not in (select coalesce(text, '') from documents where doc_id % 3 = 0)"),
    "y_embed": (embedded, "select doc_id, array_to_string(list_transform(range(0, 8), lambda i: ('0x'||substr(sha256(coalesce(text, '')), 2 * i + 1, 2))::int), ',') bytes from documents where coalesce(text, '') not in (select coalesce(text, '') from documents where doc_id % 3 = 0)"),
    "y_concept_remote": (concept_remote, _REMOTE),
    "j_neighbours_with_evidence": (neighbours_with_evidence, duck(_EVIDENCE, "v_ent", "v_edge")),
    "j_franchise_pairs": (franchise_pairs, "with m as (select 'movie:wikidata:Q'||c_custkey e, lower(c_mktsegment)||floor(c_acctbal / 10)::bigint t from customer) select a.e entity_id, b.e other_id from m a join m b on a.t = b.t and a.e <> b.e"),
    "j_exclude_family": (exclude_family, f"with {_FAM} select node entity_id, p_name title from fm join part on k = p_partkey where size = 1"),
    "y_similar_vectors": (similar_vectors, "with p as (select a.vec_id query_id, b.vec_id, b.label::varchar label, round(list_dot_product(a.embedding::double[], b.embedding::double[]), 6) score from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0), r as (select *, row_number() over (partition by query_id, label order by score desc, vec_id) \"rank\" from p) select query_id, label, \"rank\", vec_id, score from r where \"rank\" <= 5"),
    "y_nearest_vectors": (nearest_vectors, "with p as (select a.vec_id query_id, b.vec_id, round(list_dot_product(a.embedding::double[], b.embedding::double[]), 6) score from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 20 = 0), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) \"rank\" from p) select query_id, \"rank\", vec_id, score from r where \"rank\" <= 5"),
}
