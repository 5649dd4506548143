"""Queries for judgments, runs, budgets, pacing, refresh and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.cases.searching import folder
from marquee.functions import exprs as X
from marquee.operators import edges as E
from marquee.operators import judgments as J
from marquee.plans import testbed
from marquee.plans.testbed import duck
from marquee.streaming import incremental as N

LABELS = ["sequel", "prequel", "unrelated", "uncertain"]
DAY_LIMIT, STEP_US, LEASE_US = 100, 300_000_000, 6 * 3_600_000_000


def _candidates(spark, d):
    return J.candidates(testbed.edges(spark, d), testbed.previous_edges(spark, d), testbed.entities(spark, d))


def candidates(spark, d):
    return _candidates(spark, d).select("source_entity_id", "target_entity_id", "relationship", "score", "previous_relationship", "previous_score", "changed_since_previous", "input_fingerprint")


def prompts(spark, d):
    return J.prompts(_candidates(spark, d), LABELS).select("cache_key", F.md5("prompt").alias("prompt_md5"))


def changed(spark, d):
    out = J.changed_since(E.scored(testbed.edges(spark, d)), E.scored(testbed.previous_edges(spark, d)))
    return out.where("changed_since_previous").select("source_entity_id", "target_entity_id", "relationship", "previous_relationship")


def _responses(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    label = F.element_at(F.array(*[F.lit(x) for x in [*LABELS, "other"]]), (F.col("event_id") % 5 + 1).cast("int"))
    body = F.concat(F.lit('{"relationship": "'), label, F.lit('", "confidence": '), (k / 80).cast("string"), F.lit(', "reasoning": "r"'), F.when(F.col("event_id") % 11 == 0, ', "more": 1}').otherwise("}"))
    raw = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("so: "), F.left(body, F.lit(20)))).when(F.col("event_id") % 2 == 0, F.concat(F.lit("Answer: "), body, F.lit(" end"))).otherwise(body)
    return testbed.table(spark, d, "events").select("event_id", k.alias("k"), label.alias("label"), raw.alias("raw"))


def responses(spark, d):
    return J.parse_responses(_responses(spark, d), LABELS).select("event_id", "status", "relationship", "confidence", "reasoning")


def response_counts(spark, d):
    return J.decision_counts(J.parse_responses(_responses(spark, d), LABELS, "api_error"))


def _decisions(edges):
    """Every edge as an ok decision."""
    judged = F.when(F.col("relationship") == "related_anime", "uncertain").otherwise(F.col("relationship"))
    return edges.select("source_entity_id", "target_entity_id", F.concat(F.lit("j:"), "source_entity_id", F.lit(":"), "target_entity_id").alias("cache_key"), F.lit("ok").alias("status"), judged.alias("judged"), (F.size("supporting_urls") / 5.0).alias("confidence"), F.lit("f").alias("input_fingerprint"), F.lit("p").alias("provider"), F.lit("m").alias("model"), F.lit("r1").alias("recipe_version"))


def records(spark, d):
    edges = testbed.edges(spark, d)
    out = J.judgment_records(_decisions(edges), edges, testbed.entities(spark, d))
    return out.select("judgment_id", "judged", "confidence_tier", F.array_join("quality_flags", "|").alias("quality_flags"), F.array_join(F.transform("evidence_refs", lambda e: e["evidence_id"]), "|").alias("evidence_ids"))


def _gated(spark, d):
    j = testbed.judgments(spark, d)
    j = j.withColumn("inputs", F.array(F.struct(F.col("input_publishable").alias("publishable"), "allowed_uses"))).withColumn("parameters", F.create_map(F.lit("temperature"), F.when(F.col("zero_temperature"), "0").otherwise("1")))
    return J.gate(j, J.Recipe(parameters={"temperature": "0"}))


def gate(spark, d):
    return _gated(spark, d).select("judgment_id", F.array_join("reasons", "|").alias("reasons"), "eligible")


def gate_with_nulls(spark, d):
    """Every document as a judgment, many with absent values: each absent value shuts the gate."""
    return J.gate(testbed.odd_judgments(spark, d), J.Recipe(parameters={"temperature": "0"})).select("doc_id", F.array_join("reasons", "|").alias("reasons"), "eligible")


def applied(spark, d):
    return _gated(spark, d).where("eligible").select("judgment_id", "kind", "confidence")


def scores(spark, d):
    return J.run_scores(testbed.runs(spark, d))


def ranking(spark, d):
    runs = testbed.runs(spark, d)
    qualified = runs.groupBy("model").agg(F.avg("value").alias("v")).where("v > 0").select("model")
    return J.rank_models(J.run_scores(runs), qualified).select("model", "rank", "correct", "valid_json", "reachable")


def fixtures(spark, d):
    cases = spark.createDataFrame([(i, f"t{i % 3}", i % 2 == 0) for i in range(23)], "case_id long, expected_label string, expected_same boolean")
    results = testbed.table(spark, d, "events").select((F.col("user_id") % 23).alias("case_id"), F.col("event_id").alias("run_id"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("t"), (F.col("event_id") % 3).cast("string"))).alias("label"), F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 2 == 0).alias("same"))
    out = J.score_runs(results, cases)
    return out.groupBy("case_id").agg(F.count("*").alias("n"), *[F.count_if(F.col(c)).alias(c) for c in ("valid", "same_entity_correct", "label_correct")])


def budget(spark, d):
    """Every 13th request has a negative cost, which is rejected."""
    calls = testbed.requests(spark, d).withColumn("cost", F.round(F.col("value") * 100).cast("long") * F.when(F.col("event_id") % 13 == 0, -1).otherwise(1))
    return J.budget_admission(calls, 50_000, "provider", "event_id", "cost").groupBy("provider", "admitted").agg(F.count("*").alias("n"), F.max("running").alias("running"))


def daily(spark, d):
    return N.daily_budget(testbed.requests(spark, d), DAY_LIMIT)


def pacing(spark, d):
    return N.pacing(testbed.requests(spark, d).withColumn("us", F.col("us")), STEP_US).select("event_id", "provider", "wait_us", "violation")


def leases(spark, d):
    return N.lease_conflicts(testbed.requests(spark, d), LEASE_US).select("event_id", "conflict")


def uncached(spark, d):
    calls = testbed.table(spark, d, "events").select("event_id", "event_type", X.cache_key("t", "p", "m", "r", F.concat("props", F.col("user_id").cast("string"))).alias("cache_key"))
    return N.uncached(calls, calls.where("event_type = 'error'").select("cache_key").distinct()).select("event_id")


def refresh(spark, d):
    """Three batches of a job, the state handed on from one to the next until it is completed."""
    cands = testbed.candidates(spark, d).select("pos", "title")
    size = max(1, -(-cands.count() // 3))
    state = spark.createDataFrame([], "job string, snapshot_id string, status string, next_offset long, last_checkpoint_path string")
    out = None
    for i in range(3):
        rows, state = N.refresh_batch(cands, state, "anime", "s1", size)
        found = rows.agg(F.lit(i).alias("batch"), F.count("*").alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"))
        out = found if out is None else out.unionByName(found)
    last = state.first()
    return out.withColumn("next_offset", F.lit(last.next_offset)).withColumn("status", F.lit(last.status))


def stream_refresh(spark, d):
    """Documents as they land, as release candidates: validated and normalised batch by batch."""
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    work = f"{folder(spark)}/stream-{spark.sql('select uuid()').first()[0]}"
    out = N.refresh_stream(spark, f"{d}/documents.parquet", schema, work, lambda df: N.release_rows(testbed.as_candidates(df)))
    rows = spark.read.parquet(out)
    return rows.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("entities"), F.sum("release_year").alias("release_years"), F.sum("edges").alias("edges"))


def judged_records(spark, d):
    """Every edge as a decision; shows of even number count as private."""
    ents = testbed.entities(spark, d).withColumn("source_role", F.when((F.col("domain") == "tv") & (F.substring_index("entity_id", ":", -1).cast("long") % 2 == 0), "LOCAL_EVIDENCE").otherwise(F.col("source_role")))
    edges = testbed.edges(spark, d)
    return J.gate(J.judgment_records(_decisions(edges), edges, ents), J.Recipe(parameters={"temperature": "0"}))


def whole_records(spark, d):
    out = judged_records(spark, d)
    return out.select("judgment_id", "candidate_id", "provider", "model", "prompt_version", F.array_join("quality_flags", "|").alias("quality_flags"), F.array_join(F.transform("inputs", lambda i: i["publishable"].cast("string")), "|").alias("inputs"), F.size("evidence_refs").alias("evidence"), "publishable_evidence", F.array_join("reasons", "|").alias("reasons"))


def side_table(spark, d):
    """The side table as it is read again after it was written."""
    place = f"{folder(spark)}/side-{spark.sql('select uuid()').first()[0]}"
    recipe = J.Recipe(parameters={"temperature": "0"})
    summary = J.apply_to_side_table(judged_records(spark, d), recipe, place).first()
    rows = spark.read.parquet(place).groupBy("relationship_type", "materialization_recipe_version").agg(F.count("*").alias("n"), F.sum(F.size("evidence_ref_ids")).alias("evidence"))
    return rows.select("*", F.lit(summary.judged).alias("judged"), F.lit(summary.applied).alias("applied"), F.lit(summary.publishability_status).alias("publishability_status"))


def identity_responses(spark, d):
    """Events as answers to identity cases."""
    e = testbed.table(spark, d, "events")
    label = F.element_at(F.array(*[F.lit(x) for x in ("merge", "no_merge", "uncertain", "sequel")]), (F.col("event_id") % 4 + 1).cast("int"))
    body = F.concat(F.lit('{"decision": "'), label, F.lit('", "confidence": 0.5, "reasoning": "'), F.when(F.col("event_id") % 9 == 0, "").otherwise("r"), F.lit('"}'))
    raw = e.select("event_id", F.when(F.col("event_id") % 7 == 0, F.left(body, F.lit(12))).otherwise(body).alias("raw"))
    return J.parse_identity_responses(raw).select("event_id", "status", "decision")


def ordered_candidates(spark, d):
    """The first 20 candidates of each type in the order of review."""
    from marquee.operators import search as S

    return S.top(_candidates(spark, d), J.candidate_order(), 20, ["relationship"]).select("relationship", "rank", "source_entity_id", "target_entity_id", "score")


def stream_budget(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    work = f"{folder(spark)}/stream-{spark.sql('select uuid()').first()[0]}"
    out = N.daily_budget_stream(spark, f"{d}/events.parquet", schema, work, DAY_LIMIT)
    return N.daily_counts(spark, out, DAY_LIMIT)


def _landed_in_thirds(spark, d, run):
    """Events land in three parts by time, and after each the stream goes on from where it ended."""
    e = testbed.table(spark, d, "events")
    low, high = e.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    place = f"{folder(spark)}/stream-{spark.sql('select uuid()').first()[0]}"
    third = F.least(F.floor((F.unix_micros("ts") - F.lit(low)) * 3 / F.lit((high or 0) - (low or 0) + 1)), F.lit(2)).cast("int")
    for i in range(3):
        e.where(third == i).write.mode("append").parquet(f"{place}/in")
        out = run(f"{place}/in", e.schema, f"{place}/work")
    return out


def stream_windows(spark, d):
    requests = lambda df: df.withColumn("provider", F.concat(F.lit("p"), F.col("user_id") % 3))
    return N.latest_days(spark, _landed_in_thirds(spark, d, lambda source, schema, work: N.daily_budget_events(spark, source, schema, work, requests)), DAY_LIMIT)


def stream_uncached(spark, d):
    """Calls that no error row answers, each input once: the watermark spans all events."""
    calls = lambda df: df.select("ts", F.concat("props", F.col("user_id").cast("string")).alias("input")).withColumn("cache_key", X.cache_key("t", "p", "m", "r", F.col("input")))
    cache = calls(testbed.table(spark, d, "events").where("event_type = 'error'"))
    out = _landed_in_thirds(spark, d, lambda source, schema, work: N.uncached_stream(spark, source, schema, work, calls, cache, delay="400 days"))
    return spark.read.schema("ts timestamp, input string, cache_key string").parquet(out).groupBy("input").agg(F.count("*").alias("n"), F.countDistinct("cache_key").alias("keys"))


_CONF = """round(least(case {r} when 'related_anime' then 0.42::double when 'spinoff' then 0.4::double else 0.78::double end + least(len(supporting_urls) - 1, 5) * 0.04::double + least(len(list_distinct(list_transform(supporting_urls, lambda u: regexp_extract(u, '//([^/]+)/', 1)))) - 1, 4) * 0.05::double + case when {r} <> 'related_anime' and len(list_filter(supporting_urls, lambda u: u like 'https://anilist.co/%')) > 0 then 0.06::double else 0 end, 0.98), 2)"""
_CHANGED = f"""with a as (select *, {_CONF.format(r="relationship")} score from v_edge), b as (select source_entity_id, target_entity_id, relationship previous_relationship, {_CONF.format(r="relationship")} previous_score from v_prev), c as (select a.*, previous_relationship, previous_score, relationship is distinct from previous_relationship or score is distinct from previous_score changed_since_previous from a left join b using (source_entity_id, target_entity_id)) """
_SIDE = """'{{"entity_id":"'||{e}.entity_id||'","domain":"'||{e}.domain||'","title":"'||{e}.title||'","original_title":'||coalesce('"'||{e}.original_title||'"', 'null')||',"media_type":"'||{e}.media_type||'","status_":0,"release_year":'||{e}.release_year||',"genres":'||{l1}||',"studios":'||{l2}||',"creators":'||{l3}||'}}'""".replace('"status_":0,', "")
_LIST = """'['||coalesce(array_to_string(list_transform({c}, lambda x: '"'||x||'"'), ','), '')||']'"""
_SIDES = {e: _SIDE.format(e=e, l1=_LIST.format(c=f"{e}.genres"), l2=_LIST.format(c=f"{e}.studios"), l3=_LIST.format(c=f"{e}.creators")) for e in ("a", "b")}
_ENDS = f""", ce as (select c.*, {_SIDES["a"]} src, {_SIDES["b"]} tgt, len(supporting_urls) n, len(list_distinct(list_transform(supporting_urls, lambda u: regexp_extract(u, '//([^/]+)/', 1)))) p from c join v_ent a on a.entity_id = c.source_entity_id join v_ent b on b.entity_id = c.target_entity_id) """
_NORMAL = """'{{"current_confidence_score":'||score||',"current_relationship":"'||relationship||'","previous_confidence_score":'||coalesce(previous_score::varchar, 'null')||',"previous_relationship":'||coalesce('"'||previous_relationship||'"', 'null')||',"source":'||src||',"supporting_provider_count":'||p||',"supporting_source_count":'||n||',"supporting_urls":'||""".replace("{{", "{") + _LIST.format(c="supporting_urls") + """||',"target":'||tgt||'}'"""
_KEY = "'llm_judgment:'||sha256('{\"input\":\"'||replace(" + _NORMAL + """, '"', '\\"')||'","model":"model","provider":"provider","recipe_version":"relationship-judgment-v1","task":"llm_judgment"}')"""
_HEAD = "'Decide which label fits the relationship between two works.'||chr(10)||'Answer with one JSON object: relationship (one of " + ", ".join(LABELS) + "), confidence (0 to 1), reasoning.'||chr(10)||'Case:'||chr(10)"
_RECORDS = """with r as (select source_entity_id, target_entity_id, relationship, len(supporting_urls) n, case when pos % 2 = 0 then 'false' else 'true' end pub from v_edge semi join v_ent a on a.entity_id = source_entity_id semi join v_ent b on b.entity_id = target_entity_id),
 g as (select 'j:'||source_entity_id||':'||target_entity_id judgment_id, source_entity_id||':'||target_entity_id||':f' candidate_id, relationship, n, pub, 'model_inferred'||case when relationship = 'related_anime' then '|unsupported_relationship' else '' end||case when pub = 'false' then '|non_publishable_input' else '' end flags,
 concat_ws('|', case when n / 5.0::double < 0.8::double then 'confidence_below_recipe_minimum' end, case when pub = 'false' then 'blocked_quality_flag:non_publishable_input' end, case when relationship = 'related_anime' then 'blocked_quality_flag:unsupported_relationship' end, case when pub = 'false' then 'non_publishable_input_ref|input_use_not_allowed|insufficient_publishable_evidence_refs' when n = 0 then 'insufficient_publishable_evidence_refs' end) reasons from r) """
_RESP = """with e as (select event_id, json_extract(props, '$.k')::int k, ['sequel', 'prequel', 'unrelated', 'uncertain', 'other'][event_id % 5 + 1] label from events), s as (select *, case when event_id % 7 = 0 then 'parse_error' when label <> 'other' and k / 80.0::double <= 1 and event_id % 11 <> 0 then 'ok' else 'schema_error' end status from e) """
_GATE = """with g as (select judgment_id, kind, confidence, concat_ws('|', case when status <> 'approved' then 'judgment_status_not_approved' end, case when kind <> 'relationship_classification' then 'judgment_kind_not_allowed' end, case when output_schema_version <> 'v1' then 'output_schema_version_mismatch' end, case when confidence < 0.8::double then 'confidence_below_recipe_minimum' end, case when n_chars % 2 <> 0 then 'parameter_mismatch:temperature' end,
 case when toxic = 1 then 'blocked_quality_flag:low_confidence|blocked_quality_flag:unsupported_relationship' end, case when toxic <> 0 then 'non_publishable_input_ref' end, case when n_chars % 3 = 0 then 'input_use_not_allowed' end, case when n_chars % 5 = 0 then 'insufficient_publishable_evidence_refs' end) reasons from v_judg) """
_SCORES = "s as (select model, count(*) attempts, count(*) filter (reachable) reachable, count(*) filter (valid_json) valid_json, count(*) filter (correct) correct, min(nullif(latency_ms, 0)) best_latency_ms from v_run group by 1)"
_DAYS = duck("select provider, strftime(ts, '%Y-%m-%d') \"day\", count(*) n, count(*) >= 100 exhausted from v_req group by all", "v_req")

CASES = {
    "l_candidates": (candidates, duck(_CHANGED + _ENDS + f"select source_entity_id, target_entity_id, relationship, score, previous_relationship, previous_score, changed_since_previous, sha256({_NORMAL}) input_fingerprint from ce where (score < 0.7 or relationship = 'related_anime')", "v_ent", "v_edge", "v_prev")),
    "l_prompts": (prompts, duck(_CHANGED + _ENDS + f"select {_KEY} cache_key, md5({_HEAD}||{_NORMAL}) prompt_md5 from ce where (score < 0.7 or relationship = 'related_anime')", "v_ent", "v_edge", "v_prev")),
    "l_candidate_order": (ordered_candidates, duck(_CHANGED + _ENDS + "select * from (select relationship, row_number() over (partition by relationship order by score, p desc, source_entity_id, target_entity_id) \"rank\", source_entity_id, target_entity_id, score from ce where score < 0.7 or relationship = 'related_anime') where \"rank\" <= 20", "v_ent", "v_edge", "v_prev")),
    "l_judgment_records": (whole_records, duck(_RECORDS + "select judgment_id, candidate_id, 'p' provider, 'm' model, 'r1' prompt_version, flags quality_flags, 'true|'||pub inputs, n evidence, case when pub = 'true' then n else 0 end publishable_evidence, reasons from g", "v_edge", "v_ent")),
    "l_side_table": (side_table, duck(_RECORDS + "select relationship relationship_type, 'relationship-materialization-v1' materialization_recipe_version, count(*) n, sum(n)::bigint evidence, (select count(*) from g) judged, (select count(*) from g where reasons = '') applied, 'private_experiment_only' publishability_status from g where reasons = '' group by 1", "v_edge", "v_ent")),
    "l_identity_responses": (identity_responses, "with e as (select event_id, ['merge', 'no_merge', 'uncertain', 'sequel'][event_id % 4 + 1] l from events), s as (select *, case when event_id % 7 = 0 then 'parse_error' when l = 'sequel' or event_id % 9 = 0 then 'schema_error' else 'ok' end status from e) select event_id, status, case when status = 'ok' then l end decision from s"),
    "i_changed_edges": (changed, duck(_CHANGED + "select source_entity_id, target_entity_id, relationship, previous_relationship from c where changed_since_previous", "v_edge", "v_prev")),
    "l_parse_responses": (responses, _RESP + "select event_id, status, case when status = 'ok' then label end relationship, case when status = 'ok' then k / 80.0::double end confidence, case when status = 'ok' then 'r' end reasoning from s"),
    "a_decision_counts": (response_counts, _RESP + "select count(*) executed, count(*) filter (status = 'ok') ok, count(*) filter (status = 'parse_error') parse_error, count(*) filter (status = 'schema_error') api_error from s"),
    "l_records": (records, duck("select 'j:'||source_entity_id||':'||target_entity_id judgment_id, case when relationship = 'related_anime' then 'uncertain' else relationship end judged, case when len(supporting_urls) / 5.0::double >= 0.9 then 'high' when len(supporting_urls) / 5.0::double >= 0.8 then 'medium' else 'low' end confidence_tier, 'model_inferred'||case when relationship = 'related_anime' then '|unsupported_relationship' else '' end quality_flags, array_to_string(list_transform(range(1, len(supporting_urls) + 1), lambda i: 'j:'||source_entity_id||':'||target_entity_id||':supporting_url:'||i), '|') evidence_ids from v_edge", "v_edge")),
    "l_gate": (gate, duck(_GATE + "select judgment_id, reasons, reasons = '' eligible from g", "v_judg")),
    "l_gate_nulls": (gate_with_nulls, """with g as (select documents.doc_id, concat_ws('|', case when quality is null then 'judgment_status_not_approved' end, case when n_chars is null or n_chars % 4 = 0 then 'judgment_kind_not_allowed' end, case when documents.doc_id % 19 = 0 then 'output_schema_version_mismatch' end, case when documents.doc_id % 5 < 2 then 'confidence_below_recipe_minimum' end, case when documents.doc_id % 23 = 0 then 'parameter_mismatch:temperature' end,
 case when toxic is null then 'blocked_quality_flag:unknown' end, case when documents.doc_id % 13 = 0 or documents.doc_id % 7 = 0 then 'non_publishable_input_ref' end, case when documents.doc_id % 13 = 0 or documents.doc_id % 17 = 0 then 'input_use_not_allowed' end, case when documents.doc_id % 3 = 0 then 'insufficient_publishable_evidence_refs' end) reasons from documents left join labels on labels.doc_id = documents.doc_id)
 select doc_id, reasons, reasons = '' eligible from g"""),
    "l_apply": (applied, duck(_GATE + "select judgment_id, kind, confidence from g where reasons = ''", "v_judg")),
    "a_run_scores": (scores, duck(f"with {_SCORES} select * from s", "v_run")),
    "w_rank_models": (ranking, duck(f"with {_SCORES} select model, row_number() over (order by correct desc, valid_json desc, reachable desc, coalesce(best_latency_ms, 999999999), model) \"rank\", correct, valid_json, reachable from s", "v_run")),
    "l_score_runs": (fixtures, "with e as (select user_id % 23 c, event_id i from events) select c case_id, count(*) n, count(*) filter (i % 5 <> 0) valid, count(*) filter (i % 5 <> 0 and (i % 2 = 0) = (c % 2 = 0)) same_entity_correct, count(*) filter (i % 5 <> 0 and i % 3 = c % 3) label_correct from e group by 1"),
    "l_budget": (budget, duck("with c as (select provider, event_id, round(value * 100)::bigint * case when event_id % 13 = 0 then -1 else 1 end cost from v_req), r as (select provider, cost, sum(greatest(cost, 0)) over (partition by provider order by event_id rows unbounded preceding) running from c) select provider, running <= 50000 and cost >= 0 admitted, count(*) n, max(running)::bigint running from r group by all", "v_req")),
    "i_daily_budget": (daily, _DAYS),
    "w_pacing": (pacing, duck("with i as (select *, row_number() over w - 1 i, us - lag(us) over w < 300000000 v from v_req window w as (partition by provider order by us, event_id)), s as (select *, i * 300000000 + max(us - i * 300000000) over (partition by provider order by us, event_id rows unbounded preceding) st from i) select event_id, provider, (st - us)::bigint wait_us, coalesce(v, false) violation from s", "v_req")),
    "w_leases": (leases, duck("select event_id, coalesce(us < max(us + 21600000000) over (partition by provider order by us, event_id rows between unbounded preceding and 1 preceding), false) conflict from v_req", "v_req")),
    "i_uncached": (uncached, "select event_id from events where props||user_id not in (select props||user_id from events where event_type = 'error')"),
    "i_refresh": (refresh, "with o as (select doc_id, row_number() over (order by doc_id) - 1 i, ceil(count(*) over () / 3.0)::bigint s, count(*) over () t from documents) select (i // s)::int batch, count(*) n, min(doc_id) low, max(doc_id) high, any_value(t) next_offset, 'completed' status from o group by 1"),
    "i_stream_refresh": (stream_refresh, """with c as (select *, case when lang = 'es' then 'missing_required_field' when lang = 'fr' then 'missing_required_field' when n_chars % 7 = 0 then 'missing_required_field' when doc_id % 9 = 0 then 'unsupported_source_url' else 'accepted' end reason from documents)
 select reason, count(*) n, count(distinct case when reason = 'accepted' then doc_id end) entities, sum(case when reason = 'accepted' then 1950 + n_chars % 70 end)::bigint release_years, sum(case when reason = 'accepted' then 1 else 0 end)::bigint edges from c group by 1"""),
    "i_stream_budget": (stream_budget, _DAYS),
    "i_stream_windows": (stream_windows, _DAYS),
    "i_stream_uncached": (stream_uncached, "select distinct props||user_id input, 1::bigint n, 1::bigint \"keys\" from events where props||user_id not in (select props||user_id from events where event_type = 'error')"),
}
