"""Views that carry the given tables into the catalogue operators, for Spark; ``DUCK`` says the same for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.skew import dealt, join_dealt

HOSTS = ["anidb.net", "anilist.co", "myanimelist.net", "kitsu.app", "simkl.com", "anime-planet.com"]
COLUMNS = ["entity_id", "domain", "canonical_source", "source_role", "record_source", "title", "original_title", "media_type", "status", "release_year", "episodes", "synonyms", "sources", "genres", "studios", "creators", "tags"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(c).cast("timestamp").alias(c) if kind == "timestamp_ntz" else F.col(c) for c, kind in df.dtypes])


def anime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('anime:part:', p_partkey) entity_id", "'anime' domain", "concat('https://anidb.net/anime/', p_partkey) canonical_source", "'BACKBONE_SOURCE' source_role", "'manami-project/anime-offline-database@1' record_source",
        "p_name title", "if(p_partkey % 5 = 0, concat('Été ', p_name), null) original_title", "p_type media_type", "'FINISHED' status", "1990 + p_size release_year", "p_size episodes",
        "if(p_partkey % 5 = 0, array(concat(p_brand, ' ', p_name), concat('Été ', p_name), p_name), array(concat(p_brand, ' ', p_name), p_type)) synonyms",
        "array(concat('https://anidb.net/anime/', p_partkey), concat('https://anilist.co/anime/', p_partkey + 1000000)) sources",
        "array(p_type) genres", "array(p_brand) studios", "array(concat('maker ', p_size)) creators", "array_distinct(array_append(split(p_name, ' '), lower(p_type))) tags",
        "map('title', array(concat('https://anidb.net/anime/', p_partkey)), 'status', array(concat('https://anidb.net/anime/', p_partkey))) field_sources",
    )


def shows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('tv:tvmaze:', s_suppkey) entity_id", "'tv' domain", "concat('https://www.tvmaze.com/shows/', s_suppkey) canonical_source", "'BACKBONE_SOURCE' source_role", "'tvmaze' record_source",
        "s_name title", "cast(null as string) original_title", "'TV' media_type", "'UNKNOWN' status", "0 release_year", "cast(null as int) episodes", "cast(array() as array<string>) synonyms",
        "array(concat('https://www.tvmaze.com/shows/', s_suppkey)) sources", "cast(array() as array<string>) genres", "cast(array() as array<string>) studios", "cast(array() as array<string>) creators", "array(concat('network:nation_', s_nationkey)) tags",
        "map('title', array(concat('https://www.tvmaze.com/shows/', s_suppkey))) field_sources",
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('movie:wikidata:Q', c_custkey) entity_id", "'movie' domain", "concat('https://www.wikidata.org/wiki/Q', c_custkey) canonical_source", "'BACKBONE_SOURCE' source_role", "'wikidata' record_source",
        "c_name title", "cast(null as string) original_title", "'MOVIE' media_type", "'RELEASED' status", "1960 + c_nationkey release_year", "cast(null as int) episodes", "cast(array() as array<string>) synonyms",
        "array(concat('https://www.wikidata.org/wiki/Q', c_custkey)) sources", "array(c_mktsegment) genres", "cast(array() as array<string>) studios", "cast(array() as array<string>) creators",
        "array(concat('franchise:', lower(c_mktsegment), '_', cast(floor(c_acctbal / 10) as bigint))) tags",
        "map('title', array(concat('https://www.wikidata.org/wiki/Q', c_custkey))) field_sources",
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anime(spark, sf_dir).unionByName(shows(spark, sf_dir)).unionByName(movies(spark, sf_dir))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One edge per part and supplier of lineitem, dealt by both ids: joins by them need no other shuffle.

    Lines travel as they are, the flag's rank and the page (50 of each host) in one small number: few pairs occur twice, so sets made
    before the shuffle would only fill memory. A set is one bit a page, so sums stay of fixed width.
    """
    lines = table(spark, sf_dir, "lineitem")
    rank = "case when l_returnflag < 'A' then 0 when l_returnflag = 'A' then 1 when l_returnflag < 'R' then 2 when l_returnflag = 'R' then 3 else 4 end"
    rows = lines.selectExpr("concat('anime:part:', l_partkey) source_entity_id", "l_suppkey pos", "concat('tv:tvmaze:', l_suppkey) target_entity_id", f"cast({rank} * 301 + coalesce(l_linenumber % 6 * 50 + l_orderkey % 50, 300) as short) code")
    pages = [F.expr(f"bit_or(if(code % 301 div 50 = {i}, shiftleft(1L, code % 301 % 50), 0L))") for i in range(len(HOSTS))]
    g = dealt(rows, lines.count(), "source_entity_id", "target_entity_id").groupBy("source_entity_id", "pos", "target_entity_id").agg(F.min(F.expr("code div 301")).alias("rank"), *[p.alias(f"pages_{i}") for i, p in enumerate(pages)])
    numbers = lambda c: F.when(F.bit_count(c) == 1, F.array(F.length(F.bin(c)) - 1)).when(F.bit_count(c) > 1, F.filter(F.sequence(F.lit(0), F.lit(49)), lambda k: F.getbit(c, k) == 1)).otherwise(F.array().cast("array<int>"))
    named = lambda c, host: F.transform(numbers(c), lambda k: F.concat(F.lit(f"https://{host}/anime/"), k.cast("string")))
    # Nearly all edges have one page, whose number is the count of the bits below its own; the rest list theirs.
    any_page = F.coalesce(*[F.nullif(F.col(f"pages_{i}"), F.lit(0)) for i in range(len(HOSTS))])
    host = F.coalesce(*[F.when(F.col(f"pages_{i}") != 0, f"https://{h}/anime/") for i, h in enumerate(HOSTS)])
    single = sum((F.bit_count(f"pages_{i}") for i in range(1, len(HOSTS))), F.bit_count("pages_0")) == 1
    urls = F.when(single, F.array(F.concat(host, F.bit_count(any_page - 1).cast("string")))).otherwise(F.sort_array(F.concat(*[named(F.col(f"pages_{i}"), h) for i, h in enumerate(HOSTS)])))
    kind = F.when(F.col("rank") == 3, "sequel").when(F.col("rank") == 1, "prequel").otherwise("related_anime")
    return g.select("source_entity_id", "pos", "target_entity_id", kind.alias("relationship"), F.concat(F.lit("https://anilist.co/anime/"), "pos").alias("target_url"), urls.alias("supporting_urls"))


def previous_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier snapshot: every part whose key ends in 0 is absent, every seventh has another type."""
    now = edges(spark, sf_dir).withColumn("k", F.substring_index("source_entity_id", ":", -1).cast("long"))
    return now.where("k % 10 <> 0").withColumn("relationship", F.when(F.col("k") % 7 == 0, "spinoff").otherwise(F.col("relationship"))).drop("k")


def graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst): each part and the next one, where their sizes differ by less than 20."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    q = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_size").alias("next_size"))
    return join_dealt(p, q, "p_partkey").where("abs(p_size - next_size) < 20").select(F.concat(F.lit("anime:part:"), "p_partkey").alias("src"), F.concat(F.lit("anime:part:"), F.col("p_partkey") + 1).alias("dst"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_candidates(table(spark, sf_dir, "documents"))


def as_candidates(documents: DataFrame) -> DataFrame:
    """Documents as release candidates: pos is the order; language and length stand for missing and odd fields."""
    return documents.selectExpr(
        "doc_id pos", "if(lang = 'es', null, concat('title ', doc_id)) title", "if(lang = 'fr', 'CLIP', 'TV') type", "'FINISHED' status", "if(n_chars % 7 = 0, null, 1950 + cast(n_chars % 70 as int)) year",
        "if(doc_id % 9 = 0, array('https://example.org/x'), array(concat('https://myanimelist.net/anime/', doc_id, '/x'), concat('https://anidb.net/anime/', doc_id), 'https://kitsu.app/anime/a-b')) sources",
        "array(text, concat('t', doc_id)) synonyms", "array(concat('https://anilist.co/anime/', doc_id + 1), 'https://example.org/no') related", "source",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "concat('p', user_id % 3) provider", "ts", "cast(unix_micros(ts) as bigint) us", "event_type", "value", "props", "user_id")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "case when event_id % 5 = 0 then left(concat('Answer: ', props, ' end'), 11) when event_id % 5 = 1 then props else concat('Answer: ', props, ' end') end raw")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "concat('m', user_id % 23) model", "cast(round(value * 100) as bigint) latency_ms", "event_type <> 'error' reachable", "event_id % 3 <> 0 valid_json", "event_id % 4 <> 0 correct", "value")


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return docs.join(labels, "doc_id").selectExpr(
        "doc_id", "concat('j', doc_id) judgment_id", "if(quality = 1, 'approved', 'pending') status", "if(lang = 'de', 'identity_judgment', 'relationship_classification') kind", "if(lang = 'fr', 'v0', 'v1') output_schema_version",
        "(n_chars % 101) / 100.0D confidence", "if(toxic = 1, array('unsupported_relationship', 'low_confidence'), cast(array() as array<string>)) quality_flags", "toxic = 0 input_publishable",
        "if(n_chars % 3 = 0, cast(array() as array<string>), array('llm_judgment')) allowed_uses", "if(n_chars % 5 = 0, 0, 2) publishable_evidence", "n_chars % 2 = 0 zero_temperature", "source",
    )


def odd_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgments of all documents, with nulls: without a label no status, flags or publishability, and others absent by id."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(labels, "doc_id", "left").selectExpr(
        "doc_id", "if(quality is null, null, 'approved') status", "if(n_chars % 4 = 0, null, 'relationship_classification') kind", "if(doc_id % 19 = 0, null, 'v1') output_schema_version",
        "case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then double('NaN') else 0.9D end confidence", "if(toxic is null, null, cast(array() as array<string>)) quality_flags", "if(doc_id % 23 = 0, null, map('temperature', '0')) parameters",
        "if(doc_id % 13 = 0, null, array(named_struct('publishable', if(doc_id % 7 = 0, null, true), 'allowed_uses', if(doc_id % 17 = 0, null, array('llm_judgment'))))) inputs", "if(doc_id % 3 = 0, null, 2) publishable_evidence",
    )


def raw_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line of JSON for each document, as an entity; twelve of every thirteen ids plant a fault or an odd form."""
    field = lambda name, cases, rest: f"case doc_id % 13 {' '.join(f'when {k} then {v}' for k, v in cases.items())} else {rest} end"
    q = lambda name, value: f"concat('\"{name}\": ', {value}, ', ')"
    edge = """'{"target": "t", "relationship": "sequel", "target_url": "u"}'"""
    odd_edge = {3: """'{"target": 7, "relationship": "sequel", "target_url": "u"}'""", 4: """'{"target": "t", "relationship": "sequel", "target_url": "u", "more": 1}'""", 5: """'{"target": "t", "relationship": "sequel"}'"""}
    parts = [
        field("entity_id", {2: "''"}, "concat('\"entity_id\": \"e', doc_id, '\", ')"), "'\"domain\": \"anime\", \"canonical_source\": \"u\", \"media_type\": \"TV\", '", q("record_source", "concat('\"doc:', doc_id, '\"')"),
        field("title", {6: "'\"title\": 7, '", 12: "'\"title\": 7, '"}, "'\"title\": \"T\", '"), field("status", {12: "''"}, "'\"status\": \"S\", '"), q("source_role", field("", {10: "'\"FRIEND\"'"}, "'\"ID_SOURCE\"'")),
        q("release_year", field("", {1: "'\"abc\"'", 9: "'\"2009\"'"}, "cast(1950 + n_chars % 70 as string)")), q("related", f"concat('[{{\"target\": \"s\", \"relationship\": \"prequel\", \"target_url\": \"v\"}}, ', {field('', odd_edge, edge)}, ']')"),
        q("field_sources", field("", {8: "'{\"title\": \"x\"}'"}, "'{\"title\": [\"x\"]}'")), f"concat('\"synonyms\": ', {field('', {7: 'to_json(array(text, null))'}, 'to_json(array(text))')})",
    ]
    whole = f"concat('{{', {', '.join(parts)}, '}}')"
    return table(spark, sf_dir, "documents").where("doc_id is not null").selectExpr(f"if(doc_id % 13 = 11, concat('broken doc:', doc_id), {whole}) value")


def raw_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pos, raw): documents as landed release candidates; ten of every eleven ids plant a fault or an odd form."""
    case = lambda cases, rest: f"case doc_id % 11 {' '.join(f'when {k} then {v}' for k, v in cases.items())} else {rest} end"
    parts = [
        case({1: "'\"title\": 7, '", 2: "''", 8: "''"}, "concat('\"title\": \"title ', doc_id, '\", ')"), case({3: "'\"type\": \"CLIP\", '", 8: "''"}, "'\"type\": \"TV\", '"), "'\"status\": \"FINISHED\", \"picture\": {\"any\": 1}, '",
        case({4: "'\"episodes\": \"x\", '", 5: "'\"episodes\": null, '"}, "concat('\"episodes\": ', n_chars % 26, ', ')"), case({6: "'\"animeSeason\": {\"season\": 1, \"year\": \"soon\"}, '"}, "concat('\"animeSeason\": {', if(n_chars % 7 = 0, '', concat('\"year\": ', 1950 + n_chars % 70)), '}, ')"),
        case({7: "concat('\"synonyms\": ', to_json(array(text, null)), ', ')"}, "concat('\"synonyms\": ', to_json(array(text)), ', ')"), "concat('\"sources\": [', if(doc_id % 9 = 0, '\"https://example.org/x\"', concat('\"https://anidb.net/anime/', doc_id, '\"')), ']')",
    ]
    return table(spark, sf_dir, "documents").where("doc_id is not null").selectExpr("doc_id pos", f"if(doc_id % 11 = 10, '[1, 2]', concat('{{', {', '.join(parts)}, '}}')) raw")


# The same views in DuckDB's SQL.
_ANIME = """select 'anime:part:'||p_partkey entity_id, 'anime' as domain, 'https://anidb.net/anime/'||p_partkey canonical_source, 'BACKBONE_SOURCE' source_role, 'manami-project/anime-offline-database@1' record_source,
 p_name title, case when p_partkey % 5 = 0 then 'Été '||p_name end original_title, p_type media_type, 'FINISHED' status, 1990 + p_size release_year, p_size episodes,
 case when p_partkey % 5 = 0 then [p_brand||' '||p_name, 'Été '||p_name, p_name] else [p_brand||' '||p_name, p_type] end synonyms,
 ['https://anidb.net/anime/'||p_partkey, 'https://anilist.co/anime/'||(p_partkey + 1000000)] sources, [p_type] genres, [p_brand] studios, ['maker '||p_size] creators,
 case when list_contains(string_split(p_name, ' '), lower(p_type)) then string_split(p_name, ' ') else list_append(string_split(p_name, ' '), lower(p_type)) end tags from part"""
_SHOWS = """select 'tv:tvmaze:'||s_suppkey, 'tv', 'https://www.tvmaze.com/shows/'||s_suppkey, 'BACKBONE_SOURCE', 'tvmaze', s_name, null, 'TV', 'UNKNOWN', 0, null, cast([] as varchar[]),
 ['https://www.tvmaze.com/shows/'||s_suppkey], cast([] as varchar[]), cast([] as varchar[]), cast([] as varchar[]), ['network:nation_'||s_nationkey] from supplier"""
_MOVIES = """select 'movie:wikidata:Q'||c_custkey, 'movie', 'https://www.wikidata.org/wiki/Q'||c_custkey, 'BACKBONE_SOURCE', 'wikidata', c_name, null, 'MOVIE', 'RELEASED', 1960 + c_nationkey, null, cast([] as varchar[]),
 ['https://www.wikidata.org/wiki/Q'||c_custkey], [c_mktsegment], cast([] as varchar[]), cast([] as varchar[]), ['franchise:'||lower(c_mktsegment)||'_'||cast(floor(c_acctbal / 10) as bigint)] from customer"""
_HOST_LIST = "[" + ", ".join(f"'{h}'" for h in HOSTS) + "]"
DUCK = {
    "v_anime": _ANIME,
    "v_ent": f"{_ANIME} union all {_SHOWS} union all {_MOVIES}",
    "v_edge": f"""select 'anime:part:'||l_partkey source_entity_id, l_suppkey pos, 'tv:tvmaze:'||l_suppkey target_entity_id, case min(l_returnflag) when 'R' then 'sequel' when 'A' then 'prequel' else 'related_anime' end relationship,
 'https://anilist.co/anime/'||l_suppkey target_url, list_sort(list(distinct 'https://'||{_HOST_LIST}[l_linenumber % 6 + 1]||'/anime/'||(l_orderkey % 50))) supporting_urls, l_partkey k from lineitem group by l_partkey, l_suppkey""",
    "v_prev": "select * replace (case when k % 7 = 0 then 'spinoff' else relationship end as relationship) from v_edge where k % 10 <> 0",
    "v_cand": """select doc_id pos, case when lang = 'es' then null else 'title '||doc_id end title, case when lang = 'fr' then 'CLIP' else 'TV' end "type", 'FINISHED' status, case when n_chars % 7 = 0 then null else 1950 + n_chars % 70 end "year",
 doc_id % 9 = 0 as unsupported, text, source from documents""",
    "v_req": "select event_id, 'p'||(user_id % 3) provider, ts, epoch_us(ts) us, event_type, value, props, user_id from events",
    "v_run": "select event_id, 'm'||(user_id % 23) model, cast(round(value * 100) as bigint) latency_ms, event_type <> 'error' reachable, event_id % 3 <> 0 valid_json, event_id % 4 <> 0 correct, value from events",
    "v_judg": """select doc_id, 'j'||doc_id judgment_id, case when quality = 1 then 'approved' else 'pending' end status, case when lang = 'de' then 'identity_judgment' else 'relationship_classification' end kind, case when lang = 'fr' then 'v0' else 'v1' end output_schema_version,
 (n_chars % 101) / 100.0::double confidence, toxic, n_chars, source from documents join labels using (doc_id)""",
}
_NEEDS = {"v_prev": ["v_edge"]}


def duck(query: str, *views: str) -> str:
    """A DuckDB query with the views that it names."""
    names = list(dict.fromkeys(n for v in views for n in [*_NEEDS.get(v, []), v]))
    head = ", ".join(f"{n} as ({DUCK[n]})" for n in names)
    if not names:
        return query
    return f"with recursive {head}, {query[5:]}" if query.startswith("with ") else f"with recursive {head} {query}"
