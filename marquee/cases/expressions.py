"""Queries for column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.plans import fixed, testbed
from marquee.plans.testbed import duck

_HOSTS = "[" + ", ".join(f"'{h}'" for h in testbed.HOSTS) + "]"
_URLS = f"""v_url as (select page_id, url from pages union all select page_id, 'https://'||{_HOSTS}[page_id % 6 + 1]||'/anime/'||page_id from pages union all select page_id, 'https://'||{_HOSTS}[page_id % 6 + 1]||'/anime/'||page_id||'/x' from pages)"""
_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1))"
_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)"


def _urls(spark, d):
    pages = testbed.table(spark, d, "pages").select("page_id", "url")
    host = F.element_at(F.array(*[F.lit(h) for h in testbed.HOSTS]), (F.col("page_id") % 6 + 1).cast("int"))
    base = F.concat(F.lit("https://"), host, F.lit("/anime/"), F.col("page_id").cast("string"))
    return pages.unionByName(pages.withColumn("url", base)).unionByName(pages.withColumn("url", F.concat(base, F.lit("/x"))))


def fold_slug(spark, d):
    return testbed.table(spark, d, "part").select("p_partkey", X.fold(F.concat(F.lit("  "), F.upper("p_name"), F.lit("  Straße "))).alias("folded"), X.slug(F.col("p_name")).alias("slugged"))


def fold_documents(spark, d):
    return testbed.table(spark, d, "documents").select("doc_id", F.length(X.fold(F.col("text"))).cast("long").alias("folded_length"), X.fold(F.col("text")).contains("the").alias("has_the"))


def tags(spark, d):
    t = testbed.table(spark, d, "customer")
    made = t.select("c_custkey", F.array(F.concat(F.lit("x"), F.col("c_name")), X.prefixed_tag("segment", F.col("c_mktsegment")), X.prefixed_tag("segment", F.col("c_name"))).alias("tags"))
    return made.select("c_custkey", F.array_join("tags", "|").alias("tags"), X.tag_value(F.col("tags"), "segment").alias("value"))


def source_refs(spark, d):
    ref = X.parse_source_ref(F.col("url"))
    return _urls(spark, d).select("page_id", "url", ref.alias("r")).select("page_id", "url", "r.provider", "r.external_id", "r.alias_id")


def providers(spark, d):
    return _urls(spark, d).groupBy(X.provider_of(F.col("url")).alias("provider")).agg(F.count("*").alias("n"))


def canonical_refs(spark, d):
    urls = _urls(spark, d).withColumn("ref", X.parse_source_ref(F.col("url"))).where("ref is not null")
    refs = urls.groupBy((F.col("page_id") / 3).cast("long").alias("k")).agg(F.array_sort(F.collect_list("ref")).alias("refs"))
    return refs.select("k", X.pick_canonical(F.col("refs")).alias("r")).select("k", "r.alias_id")


def arrays(spark, d):
    t = testbed.table(spark, d, "part").select("p_partkey", F.array(F.col("p_type"), F.lit(None), F.col("p_brand"), F.col("p_type"), F.lit("A")).alias("a"))
    return t.select("p_partkey", F.array_join(X.dedupe_keep_order(F.col("a")), "|").alias("kept"), F.array_join(X.sorted_distinct(F.col("a")), "|").alias("ordered"))


def original_titles(spark, d):
    t = testbed.table(spark, d, "documents").select("doc_id", X.original_title(F.array(F.concat(F.lit("t"), "doc_id"), F.col("text"))).alias("o"))
    return t.select("doc_id", F.md5("o").alias("original_md5"))


def years(spark, d):
    t = testbed.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("s"), "o_orderpriority")
    return t.select("o_orderkey", X.year_of(F.col("s")).alias("of_date"), X.year_of(F.concat(F.left("s", F.lit(4)), F.lit("-xx"))).alias("of_prefix"), X.year_of(F.col("o_orderpriority")).alias("of_other"), X.zero_to_null(F.col("o_orderkey") % 5).alias("nulled"))


def ids(spark, d):
    t = testbed.table(spark, d, "part")
    return t.select("p_partkey", X.stable_id(F.lit("title"), F.col("p_partkey").cast("string"), F.col("p_name")).alias("stable"))


def json_ids(spark, d):
    t = testbed.edges(spark, d)
    key = X.json_id("relationship", source_entity_id=F.col("source_entity_id"), target_entity_id=F.col("target_entity_id"), relationship=F.col("relationship"))
    cached = X.cache_key("judgment", "p", "m", "r1", F.col("relationship"))
    return t.select("source_entity_id", "target_entity_id", key.alias("relationship_id"), cached.alias("cache_key"))


def json_text(spark, d):
    t = testbed.table(spark, d, "events")
    return t.select("event_id", X.canonical_json(user=F.col("user_id"), kind=F.col("event_type"), none=F.lit(None).cast("string"), props=F.col("props")).alias("json"))


def hashes(spark, d):
    t = testbed.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rows = t.withColumn("h", X.record_hash("s_suppkey", "s_name", "s_nationkey"))
    return rows.groupBy("s_nationkey").agg(X.content_hash(F.col("s_suppkey"), F.col("h")).alias("content_hash"))


def json_objects(spark, d):
    return testbed.responses(spark, d).select("event_id", X.extract_json_object(F.col("raw")).alias("object"))


def hash_vectors(spark, d):
    t = testbed.table(spark, d, "documents").select("doc_id", X.hash_embedding(F.coalesce("text", F.lit("")), 8).alias("v"))
    return t.select("doc_id", *[F.element_at("v", i + 1).alias(f"v{i}") for i in range(8)])


def lineage_merge(spark, d):
    t = testbed.table(spark, d, "part")
    a = F.create_map(F.lit("title"), F.array("p_name"), F.lit("status"), F.array("p_type"))
    b = F.create_map(F.lit("title"), F.array("p_brand", "p_name"), F.lit("genres"), F.array("p_brand"))
    m = t.select("p_partkey", X.merge_lineage(a, b).alias("m"))
    return m.select("p_partkey", *[F.array_join(F.try_element_at("m", F.lit(k)), "|").alias(k) for k in ("title", "status", "genres")])


_PROVIDER = "case " + _HOST + " " + " ".join(f"when '{h}' then '{p}'" for h, p in fixed.HOST_PROVIDERS.items()) + " else url end"
_REF = "case " + " ".join(f"when {_HOST} = '{h}' then nullif(regexp_extract({_PATH}, '{p}', 1), '')" for h, (_, p) in fixed.SOURCE_PATTERNS.items()) + " end"
_REFS = f"with {_URLS}, r as (select page_id, url, {_REF} external_id, case when {_REF} is not null then {_PROVIDER} end provider from v_url) "
_RANK = "case provider " + " ".join(f"when '{p}' then {i}" for i, p in enumerate(fixed.PREFERRED_PROVIDERS)) + " end"
_BYTE = "round(('0x'||substr(sha256(coalesce(text, '')), {0}, 2))::int / 255.0::double * 2 - 1, 6)"

CASES = {
    "x_fold_slug": (fold_slug, "select p_partkey, trim(regexp_replace(replace(lower('  '||upper(p_name)||'  Straße '), 'ß', 'ss'), '\\s+', ' ', 'g')) folded, replace(lower(trim(p_name)), ' ', '_') slugged from part"),
    "x_fold_documents": (fold_documents, "with f as (select doc_id, trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '\\s+', ' ', 'g')) t from documents) select doc_id, length(t) folded_length, contains(t, 'the') has_the from f"),
    "x_tags": (tags, "select c_custkey, 'x'||c_name||'|segment:'||replace(lower(trim(c_mktsegment)), ' ', '_')||'|segment:'||replace(lower(trim(c_name)), ' ', '_') tags, replace(lower(trim(c_mktsegment)), ' ', '_') \"value\" from customer"),
    "x_source_refs": (source_refs, _REFS + "select page_id, url, provider, external_id, 'anime:'||provider||':'||external_id alias_id from r"),
    "x_providers": (providers, f"with {_URLS} select {_PROVIDER} provider, count(*) n from v_url group by 1"),
    "x_canonical_refs": (canonical_refs, _REFS + f"select page_id // 3 k, 'anime:'||arg_max(provider||':'||external_id, [-({_RANK}), row_n]) alias_id from (select *, row_number() over (partition by page_id // 3 order by provider, external_id, url) row_n from r where external_id is not null) group by 1"),
    "x_arrays": (arrays, "select p_partkey, p_type||'|'||p_brand||case when p_type = 'A' or p_brand = 'A' then '' else '|A' end kept, array_to_string(list_sort(list_distinct([p_type, p_brand, 'A'])), '|') ordered from part"),
    "x_original_titles": (original_titles, "select doc_id, case when regexp_matches(text, '[^\\x00-\\x7F]') then md5(text) end original_md5 from documents"),
    "x_years": (years, "select o_orderkey, year(o_orderdate)::int of_date, year(o_orderdate)::int of_prefix, try_cast(left(o_orderpriority, 4) as int) of_other, nullif(o_orderkey % 5, 0) nulled from orders"),
    "x_stable_ids": (ids, "select p_partkey, 'title:'||p_partkey||':'||left(sha256(p_name), 16) stable from part"),
    "x_json_ids": (json_ids, duck("""select source_entity_id, target_entity_id, 'relationship:'||left(sha256('{"relationship":"'||relationship||'","source_entity_id":"'||source_entity_id||'","target_entity_id":"'||target_entity_id||'"}'), 20) relationship_id,
 'judgment:'||sha256('{"input":"'||relationship||'","model":"m","provider":"p","recipe_version":"r1","task":"judgment"}') cache_key from v_edge""", "v_edge")),
    "x_json_text": (json_text, """select event_id, '{"kind":"'||event_type||'","none":null,"props":"'||replace(props, '"', '\\"')||'","user":'||user_id||'}' "json" from events"""),
    "x_hashes": (hashes, """with h as (select s_suppkey, s_nationkey, left(sha256('{"s_suppkey":'||s_suppkey||',"s_name":"'||s_name||'","s_nationkey":'||s_nationkey||'}'), 16) h from supplier) select s_nationkey, sha256(string_agg(h, chr(10) order by s_suppkey)) content_hash from h group by 1"""),
    "x_json_objects": (json_objects, "select event_id, case when event_id % 5 <> 0 then props end \"object\" from events"),
    "x_hash_vectors": (hash_vectors, "select doc_id, " + ", ".join(f"{_BYTE.format(2 * i + 1)} v{i}" for i in range(8)) + " from documents"),
    "x_lineage_merge": (lineage_merge, "select p_partkey, case when p_name = p_brand then p_name else p_name||'|'||p_brand end title, p_type status, p_brand genres from part"),
}
