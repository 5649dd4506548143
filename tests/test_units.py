"""Operators on hand-made rows: quirks, gates, files, identity, streams."""

import json
import random

import pytest
from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.operators import edges as E
from marquee.operators import gates as G
from marquee.operators import ingest as I
from marquee.operators import judgments as J
from marquee.operators import prefixes as P
from marquee.operators import search as S
from marquee.operators import tables as B
from marquee.plans import testbed
from marquee.sources import readers as R
from marquee.sources import writers as W
from marquee.streaming import incremental as N

EDGE = "source_entity_id string, pos int, target_entity_id string, relationship string, target_url string, supporting_urls array<string>"


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def one(spark, expression, ddl, *row):
    return spark.createDataFrame([row], ddl).select(expression.alias("x")).first().x


def test_fold_and_strict_fold(spark):
    assert one(spark, X.fold(F.col("a")), "a string", "  Straße \t X ") == "strasse x"
    assert one(spark, X.fold_strict(F.col("a")), "a string", "  Straße \t ΣΑΣ ") == "strasse σασ"
    assert one(spark, X.fold(F.col("a")), "a string", None) is None


def test_confidence_matches_published_examples(spark):
    rows = [("a", 0, "b", "sequel", "https://anilist.co/anime/1", [f"https://{h}/anime/{i}" for i, h in enumerate(["anidb.net", "anilist.co", "myanimelist.net", "kitsu.app", "simkl.com"])]), ("a", 1, "c", "related_anime", "https://anidb.net/anime/2", []), ("a", 2, "d", "never_heard", "https://x.example/2", ["https://x.example/2"])]
    got = {r.target_entity_id: (r.score, r.confidence_tier, r.relationship_family) for r in E.scored(spark.createDataFrame(rows, EDGE)).collect()}
    assert got == {"b": (0.98, "high", "continuity"), "c": (0.42, "review", "uncertain"), "d": (0.4, "review", "uncertain")}


def test_source_references(spark):
    urls = ["https://ANIDB.net/anime/7", "https://www.anidb.net/anime/7", "https://anidb.net/anime/7/x", "https://myanimelist.net/anime/9/name", "https://kitsu.app/anime/a-b", "no url", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string").select("i", X.parse_source_ref(F.col("u"))["alias_id"].alias("a"))
    assert [r.a for r in df.orderBy("i").collect()] == ["anime:anidb:7", None, None, "anime:myanimelist:9", "anime:kitsu:a-b", None, None]


def test_canonical_takes_last_of_the_preferred_provider(spark):
    urls = F.array(*[F.lit(u) for u in ("https://myanimelist.net/anime/1", "https://anidb.net/anime/2", "https://anidb.net/anime/3")])
    assert one(spark, X.pick_canonical(F.filter(F.transform(urls, X.parse_source_ref), lambda r: r.isNotNull()))["url"], "a int", 1) == "https://anidb.net/anime/3"


def test_json_objects(spark):
    texts = ['{"a": 1}', 'so {"a": 1} end', "[1]", "3", "no", '{"a": ', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.extract_json_object(F.col("t")).alias("o"))
    assert [r.o for r in df.orderBy("i").collect()] == ['{"a": 1}', '{"a": 1}', None, None, None, None, None]


def test_snapshot_time_and_roles(spark):
    assert str(one(spark, X.snapshot_time(F.col("a")), "a string", "tvmaze:2026-04-27").date()) == "2026-04-27"
    assert str(one(spark, X.snapshot_time(F.col("a")), "a string", "odd").date()) == "1970-01-01"
    staff = [{"role": "Original  Creator", "full": "A", "native": "a"}, {"role": "Director", "full": "B", "native": "b"}, {"role": "original work", "full": "", "native": "c"}]
    assert one(spark, X.creator_names(F.col("s")), "s array<struct<role:string,full:string,native:string>>", [tuple(x.values()) for x in staff]) == ["A", "c"]
    assert one(spark, X.main_or_all(F.col("s")), "s array<struct<isMain:boolean,name:string>>", [(False, "x"), (True, "y")]) == ["y"]
    assert one(spark, X.main_or_all(F.col("s")), "s array<struct<isMain:boolean,name:string>>", [(False, "x"), (False, "z")]) == ["x", "z"]


def test_concept_rank(spark):
    media = spark.createDataFrame([(1, "", "Eng", None, ["Romance"], [("College", 80), ("Other", 5)], ["Romance", "Action"], ["College"], 77), (2, None, None, None, [], [], ["Romance"], [], None)], "id int, romaji string, english string, native string, genres array<string>, tags array<struct<name:string,rank:int>>, wanted_genres array<string>, wanted_tags array<string>, score int")
    got = {r.id: (r.title, r.strength, r.rationale) for r in S.concept_rank(media).collect()}
    assert got == {1: ("Eng", 80, "genre match: Romance; tag match: College; AniList score 77"), 2: ("2", 0, "matched AniList filters")}


def test_families_equal_union_find(spark, tmp_path):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(300):03}", f"n{rng.randrange(300):03}") for _ in range(220)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = dict(values(S.families(spark.createDataFrame(edges, "src string, dst string"), f"file://{tmp_path}"), "node", "family"))
    assert got == {n: find(n) for a, b in edges if a != b for n in (a, b)}


def test_best_title_result(spark):
    rows = [("X y", 0, "other", None, None, 30, 2001, "u"), ("X y", 1, "x  Y", None, None, 1, 2000, "u"), ("X y", 2, "X Y", None, None, 1, 2000, "u"), ("z", 0, "z", None, None, 1, None, "u")]
    got = I.best_title_result(spark.createDataFrame(rows, "search string, pos int, romaji string, english string, native string, episodes int, year int, url string"))
    assert values(got, "search", "pos") == [("X y", 1)]


def test_slices_cover_everything_once(spark):
    df = spark.createDataFrame([(i * i,) for i in range(50)], "pos long")
    for size, n in ((1, 9), (7, 50), (50, 50)):
        part, got, at = df.where(F.col("pos") < n * n), [], 0
        while at < n:
            rows, at = I.slice_candidates(part, at, size)
            got += [r.pos for r in rows.collect()]
        assert sorted(got) == [i * i for i in range(n)]
    with pytest.raises(ValueError):
        I.slice_candidates(df, -1, 5)
    with pytest.raises(ValueError):
        I.slice_candidates(df, 51, 5)


def test_identity_chains_and_cycles(spark, tmp_path):
    ids = spark.createDataFrame([(x,) for x in "abcdw"], "entity_id string")
    changes = spark.createDataFrame([("a", ["b"]), ("b", ["c", "d"]), ("w", [])], "old_entity_id string, new_entity_ids array<string>")
    assert sorted(values(G.resolve_identity(ids, changes, f"file://{tmp_path}"), "entity_id", "current_id")) == [("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "c"), ("d", "d")]
    with pytest.raises(ValueError):
        G.resolve_identity(ids, spark.createDataFrame([("a", ["b"]), ("b", ["a"])], "old_entity_id string, new_entity_ids array<string>"), f"file://{tmp_path}")


def test_long_identity_chains_take_few_rounds(spark, tmp_path, monkeypatch):
    rounds = []
    plain = G.kept
    monkeypatch.setattr(G, "kept", lambda *a: rounds.append(1) or plain(*a))
    chain = [(f"n{i}", [f"n{i + 1}"]) for i in range(1000)] + [("fork", ["n0", "n990", "gone", "end"]), ("gone", []), ("loop", ["pool"]), ("pool", ["loop"])]
    changes = spark.createDataFrame(chain, "old_entity_id string, new_entity_ids array<string>").coalesce(2)
    ids = spark.createDataFrame([("n0",), ("n0",), ("n998",), ("fork",), ("gone",), ("new",)], "entity_id string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = values(G.resolve_identity(ids, changes, f"file://{tmp_path}"), "entity_id", "current_id")
    assert sorted(got) == [("fork", "end"), ("fork", "n1000"), ("n0", "n1000"), ("n998", "n1000"), ("new", "new")]
    assert len(rounds) <= 12 and before
    assert len([f for f in tmp_path.iterdir() if f.name.startswith("identity")]) == 1  # earlier rounds are deleted
    with pytest.raises(ValueError):
        G.resolve_identity(spark.createDataFrame([("pool",)], "entity_id string"), changes, f"file://{tmp_path}")


def test_assert_clean(spark):
    G.assert_clean(spark.createDataFrame([("r", "s", "warning")], "rule string, subject string, severity string"))
    with pytest.raises(ValueError):
        G.assert_clean(spark.createDataFrame([("r", "s", "error")], "rule string, subject string, severity string"))


def test_gate_lists_every_reason_in_order(spark):
    schema = "judgment_id string, status string, kind string, output_schema_version string, confidence double, quality_flags array<string>, inputs array<struct<publishable:boolean,allowed_uses:array<string>>>, publishable_evidence int, parameters map<string,string>"
    rows = [("ok", "approved", "relationship_classification", "v1", 0.8, [], [(True, ["llm_judgment"])], 1, {"temperature": "0"}), ("bad", "pending", "other", "v0", 0.79, ["unsupported_relationship", "low_confidence"], [(False, [])], 0, {})]
    got = {r.judgment_id: r.reasons for r in J.gate(spark.createDataFrame(rows, schema), J.Recipe(parameters={"temperature": "0"})).collect()}
    assert got["ok"] == []
    assert got["bad"] == ["judgment_status_not_approved", "judgment_kind_not_allowed", "output_schema_version_mismatch", "confidence_below_recipe_minimum", "parameter_mismatch:temperature", "blocked_quality_flag:low_confidence", "blocked_quality_flag:unsupported_relationship", "non_publishable_input_ref", "input_use_not_allowed", "insufficient_publishable_evidence_refs"]


def test_merge_cards(spark):
    cards = [("a", "b", "sequel", "outgoing", 1), ("a", "b", "sequel", "outgoing", 4), ("a", "c", "sequel", "incoming", 2), ("a", "c", "sequel", "incoming", 0), ("a", "d", "sequel", "outgoing", 1), ("a", "d", "sequel", "incoming", 0)]
    got = S.merge_cards(spark.createDataFrame(cards, "entity_id string, other_id string, relationship string, direction string, pos int"))
    assert sorted(values(got, "other_id", "direction", "pos")) == [("b", "outgoing", 4), ("c", "incoming", 0), ("d", "bidirectional", 1)]


def test_files(spark, tmp_path):
    entity = {"entity_id": "anime:x:1", "domain": "anime", "canonical_source": "u", "source_role": "ID_SOURCE", "record_source": "r", "title": "T", "media_type": "TV", "status": "FINISHED", "release_year": 2001, "related": [{"target": "anime:x:2", "relationship": "sequel", "target_url": "u", "supporting_urls": []}]}
    (tmp_path / "c.jsonl").write_text("\n".join([json.dumps(entity), "", json.dumps(entity | {"odd": 1}), "[1]"]))
    good, bad = R.read_entities(spark, f"file://{tmp_path}/c.jsonl")
    assert values(good, "entity_id", "title") == [("anime:x:1", "T")]
    assert sorted(values(bad, "reason")) == [("not_an_object",), ("unknown_key",)]
    edges = R.flat_edges(good)
    assert values(edges, "source_entity_id", "target_entity_id") == [("anime:x:1", "anime:x:2")]
    (tmp_path / "r.json").write_text(json.dumps({"repository": "r", "lastUpdate": "d", "data": [{"title": "A", "sources": ["https://anidb.net/anime/1"], "type": "TV", "status": "FINISHED", "animeSeason": {"year": 2001}, "synonyms": [], "relatedAnime": []}, {"title": "B"}]}))
    release = I.validate(R.read_release(spark, f"file://{tmp_path}/r.json", 2))
    assert sorted(values(release, "pos", "reason", "detail")) == [(0, None, None), (1, "missing_required_field", "sources,status,type")]
    (tmp_path / "s.json").write_text(json.dumps({"results": {"bindings": [{"item": {"value": "http://w/Q5"}, "genres": {"value": "b|a|| b"}, "runtime": {"value": "90.0"}}]}}))
    assert values(R.read_sparql_bindings(spark, f"file://{tmp_path}/s.json"), "qid", "label", "genres", "runtime_minutes") == [("Q5", "Q5", [" b", "a", "b"], 90)]
    (tmp_path / "t.json").write_text(json.dumps({"id": 3, "url": "u", "name": "N", "genres": ["b", "a", "b"], "premiered": "2001-02-03", "webChannel": {"name": "W"}, "_embedded": {"episodes": [{"id": 1}]}}))
    shows = I.normalize_shows(R.read_show_payloads(spark, f"file://{tmp_path}/t.json"))
    assert values(shows, "entity_id", "release_year", "episodes", "tags") == [("tv:tvmaze:3", 2001, 1, ["a", "b", "network:w"])]


ENTITY = {"entity_id": "e", "domain": "anime", "canonical_source": "u", "source_role": "BACKBONE_SOURCE", "record_source": "r", "title": "T", "media_type": "TV", "status": "S", "release_year": 2001}
EDGE_OF = {"target": "t", "relationship": "sequel", "target_url": "u"}


@pytest.mark.parametrize(("change", "reason", "detail"), [
    ({"release_year": "abc"}, "wrong_type", "release_year"), ({"release_year": 2001.5}, "wrong_type", "release_year"), ({"release_year": 99999999999}, "wrong_type", "release_year"), ({"release_year": None}, "wrong_type", "release_year"),
    ({"entity_id": None}, "wrong_type", "entity_id"), ({"entity_id": 7}, "wrong_type", "entity_id"), ({"entity_id": "-"}, "missing_required_field", "entity_id"), ({"source_role": "FRIEND"}, "wrong_type", "source_role"),
    ({"synonyms": ["a", 1, None]}, "wrong_type", "synonyms.1,synonyms.2"), ({"tags": "x"}, "wrong_type", "tags"), ({"genres": None}, "wrong_type", "genres"), ({"field_sources": {"title": ["u"], "year": "u"}}, "wrong_type", "field_sources.year"),
    ({"related": [EDGE_OF, EDGE_OF | {"target": 5}]}, "wrong_type", "related.1.target"), ({"related": [{"target": "t", "relationship": "r"}]}, "missing_required_field", "related.0.target_url"), ({"related": [EDGE_OF | {"more": 1}]}, "unknown_key", "related.0.more"),
    ({"related": [EDGE_OF, "x"]}, "wrong_type", "related.1"), ({"other": {}}, "unknown_key", "other"), ({"title": 7, "status": "-"}, "missing_required_field", "status"),
    ({}, None, None), ({"release_year": "2001"}, None, None), ({"release_year": 2001.0}, None, None), ({"episodes": None, "original_title": None}, None, None), ({"related": [EDGE_OF]}, None, None),
])
def test_strict_entities(spark, tmp_path, change, reason, detail):
    (tmp_path / "e.jsonl").write_text(json.dumps({k: v for k, v in (ENTITY | change).items() if v != "-"}))
    good, bad = R.read_entities(spark, f"file://{tmp_path}/e.jsonl")
    assert values(bad, "reason", "detail") == ([(reason, detail)] if reason else [])
    assert values(good, "release_year", "synonyms") == ([] if reason else [(2001, [])])


def test_raw_candidates(spark):
    base = {"title": "A", "sources": ["https://anidb.net/anime/1"], "type": "TV", "status": "FINISHED", "animeSeason": {"year": 2001}, "more": 1}
    bad = "missing_required_field"
    cases = [
        (json.dumps(base), (None, None, None)), ("[1]", (bad, "candidate_shape", [])), ("no", (bad, "candidate_shape", [])), (None, (bad, "candidate_shape", [])), (json.dumps(base | {"title": 7}), (bad, "candidate_shape", ["title"])),
        (json.dumps(base | {"title": None}), (bad, "candidate_shape", ["title"])), (json.dumps(base | {"episodes": "x"}), (bad, "candidate_shape", ["episodes"])), (json.dumps(base | {"episodes": "12"}), (None, None, None)),
        (json.dumps(base | {"sources": ["a", 1]}), (bad, "candidate_shape", ["sources.1"])), (json.dumps(base | {"type": "CLIP"}), (bad, "candidate_shape", ["type"])), (json.dumps(base | {"animeSeason": None}), (bad, "candidate_shape", ["animeSeason"])),
        (json.dumps(base | {"animeSeason": {"year": "soon", "season": 1}}), (bad, "candidate_shape", ["animeSeason.season", "animeSeason.year"])), (json.dumps(base | {"animeSeason": {}}), (bad, "animeSeason.year", ["animeSeason.year"])),
        (json.dumps({"title": 5, "type": "TV"}), (bad, "sources,status", ["sources", "status"])), (json.dumps(base | {"sources": []}), ("unsupported_source_url", "sources", ["sources"])), (json.dumps(base | {"synonyms": None}), (bad, "candidate_shape", ["synonyms"])),
    ]
    out = I.validate_raw(spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(cases)], "pos int, raw string")).orderBy("pos")
    assert values(out, "reason", "detail", "fields") == [want for _, want in cases]
    assert [r.title is None for r in out.collect()] == [bool(want[0]) and want[1] not in ("animeSeason.year", "sources") for _, want in cases]


def test_gate_is_shut_for_absent_values(spark):
    schema = "status string, kind string, output_schema_version string, confidence double, parameters map<string,string>, quality_flags array<string>, inputs array<struct<publishable:boolean,allowed_uses:array<string>>>, publishable_evidence int, provider string"
    good = ["approved", "relationship_classification", "v1", 0.9, {"t": "0"}, [], [(True, ["llm_judgment"])], 1, "p"]
    every = ["judgment_status_not_approved", "judgment_kind_not_allowed", "output_schema_version_mismatch", "confidence_below_recipe_minimum", "provider_mismatch", "parameter_mismatch:t", "blocked_quality_flag:unknown", "non_publishable_input_ref", "input_use_not_allowed", "insufficient_publishable_evidence_refs"]
    rows, want = [good, [None] * 9], [[], every]
    single = [every[0], every[1], every[2], every[3], every[5], every[6], None, every[9], every[4]]
    for i, reason in enumerate(single):
        rows.append([None if i == k else v for k, v in enumerate(good)])
        want.append([reason] if reason else [every[7], every[8]])
    for i, value, reasons in ((3, float("nan"), [every[3]]), (6, [], [every[7], every[8]]), (6, [(None, None)], [every[7], every[8]]), (6, [(True, ["llm_judgment"]), None], [every[7], every[8]]), (4, {"t": None}, [every[5]]), (5, ["fine", None], [])):
        rows.append([value if i == k else v for k, v in enumerate(good)])
        want.append(reasons)
    out = J.gate(spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], schema + ", n int"), J.Recipe(provider="p", parameters={"t": "0"})).orderBy("n")
    assert values(out, "reasons", "eligible") == [(w, not w) for w in want]


def test_writers(spark, tmp_path):
    frames = {"a": spark.range(3), "b": spark.range(5)}
    assert sorted(values(W.materialize_snapshot(frames, f"file://{tmp_path}", "job", "s1"), "table_name", "row_count")) == [("a", 3), ("b", 5)]
    assert W.current(spark, f"file://{tmp_path}", "job")[1]["b"].count() == 5
    W.write_jsonl(spark.sql("select 1 a, cast(null as string) b"), f"file://{tmp_path}/j")
    assert spark.read.text(f"file://{tmp_path}/j").first().value == '{"a":1,"b":null}'
    edges = spark.createDataFrame([("anime:x:1", "anime:x:2", "sequel"), ("gone", "anime:x:2", "sequel")], "source_entity_id string, target_entity_id string, relationship_type string")
    W.write_corpus(spark.createDataFrame([("anime:x:1",)], "entity_id string"), edges, f"file://{tmp_path}/corpus")
    assert values(R.read_catalog(spark, f"file://{tmp_path}/corpus/entities.parquet", f"file://{tmp_path}/corpus/relationships.parquet")[1], "source_entity_id", "relationship") == [("anime:x:1", "sequel")]


def test_publishing_is_one_step(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}"
    assert W.current(spark, root, "job") is None
    W.materialize_snapshot({"a": spark.range(3), "b": spark.range(5)}, root, "job", "s1")
    broken = {"a": spark.range(4), "b": spark.range(6).selectExpr("id", "raise_error('stop') x")}
    with pytest.raises(Exception, match="stop"):
        W.materialize_snapshot(broken, root, "job", "s2")
    name, tables = W.current(spark, root, "job")
    assert name == "s1" and {n: t.count() for n, t in tables.items()} == {"a": 3, "b": 5}  # though s2's first table is written
    W.materialize_snapshot({"a": spark.range(4), "b": spark.range(6)}, root, "job", "s2")
    name, tables = W.current(spark, root, "job")
    assert name == "s2" and {n: t.count() for n, t in tables.items()} == {"a": 4, "b": 6} and W.pointers(spark, root, "job") == [1, 2]
    with pytest.raises(ValueError):
        W.materialize_snapshot({"a": spark.range(1)}, root, "job", "s2")
    monkeypatch.setattr(W, "pointers", lambda *a: [1])  # two runs that saw the same state
    with pytest.raises(RuntimeError):
        W.publish(spark, root, "job", {})


def test_audit_rows_keep_the_last(spark, tmp_path):
    (tmp_path / "1.jsonl").write_text('{"source_id": "a", "n": 1}\n{"source_id": "b", "n": 2}')
    (tmp_path / "2.jsonl").write_text('{"source_id": "a", "n": 3}\n{"source_id": "a", "n": 4}')
    assert sorted(values(R.read_audit(spark, "source_id string, n int", f"file://{tmp_path}/1.jsonl", f"file://{tmp_path}/2.jsonl"), "source_id", "n")) == [("a", 4), ("b", 2)]


def test_audit_rows_of_many_files_and_blocks(spark, tmp_path):
    # Large files come first in Spark's tasks, and a file is cut into many of them.
    folder = tmp_path / "many"
    folder.mkdir()
    for k, lines in enumerate((2, 3000, 1, 4000, 5)):
        (folder / f"{k}.jsonl").write_text("".join(json.dumps({"source_id": f"s{i % 7}", "n": k * 10_000 + i}) + "\n" for i in range(lines)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = dict(values(R.read_audit(spark, "source_id string, n int", f"file://{folder}"), "source_id", "n"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"s{i}": 40_000 + i for i in range(5)} | {"s5": 30_000 + 3999 - (3999 - 5) % 7, "s6": 30_000 + 3999 - (3999 - 6) % 7}


def test_state(spark):
    state = spark.createDataFrame([("j", "s", "in_progress", 5, "p")], "job string, snapshot_id string, status string, next_offset long, last_checkpoint_path string")
    assert N.resume_offset(state, "j", "s") == 5 and N.resume_offset(state, "j", "other") == 0
    assert values(N.finalize(state, "j"), "status", "next_offset") == [("completed", 5)]
    assert sorted(values(N.finalize(state, "k"), "job", "status", "next_offset")) == [("j", "in_progress", 5), ("k", "completed", 0)]


def test_stream_restart_adds_nothing_twice(spark, tmp_path):
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    spark.range(10).repartition(3).write.parquet(source)
    schema = spark.range(1).schema
    N.refresh_stream(spark, source, schema, work, lambda df: df)
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(source)
    out = N.refresh_stream(spark, source, schema, work, lambda df: df)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(15))


def test_stream_budget_counts_all_rows_of_unordered_files(spark, tmp_path):
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    days = [30, 30, 1, 15, 2, 30, 29, 1]
    for i, day in enumerate(days):
        rows = spark.range(6).selectExpr("id user_id", f"timestamp '2024-01-{day:02} 23:50:00' ts")
        rows.coalesce(1).write.mode("append").parquet(source)
    schema = spark.read.parquet(source).schema
    out = N.daily_budget_stream(spark, source, schema, work, 5)
    got = N.daily_counts(spark, out, 5)
    assert sorted(values(got, "provider", "day", "n", "exhausted")) == sorted((f"p{p}", f"2024-01-{d:02}", 2 * days.count(d), 2 * days.count(d) >= 5) for p in range(3) for d in set(days))
    spark.range(3).selectExpr("id user_id", "timestamp '2024-01-01 00:00:01' ts").coalesce(1).write.mode("append").parquet(source)
    N.daily_budget_stream(spark, source, schema, work, 5)
    assert {r.n for r in N.daily_counts(spark, out, 5).where("day = '2024-01-01'").collect()} == {5}


def test_nearest_vectors_of_any_label(spark):
    rng = random.Random(3)
    data = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)], None if i % 3 == 0 else i % 4) for i in range(130)]
    got = S.nearest_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), chunk_bytes=20 * 24, query_bytes=3 * 24)
    want = [(i, n + 1, j, -s) for i, x, _ in data if i % 20 == 0 for n, (s, j) in enumerate(sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y, _ in data if j != i)[:5])]
    assert sorted(values(got, "query_id", "rank", "vec_id", "score")) == want
    assert S.nearest_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0
    got = S.nearest_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), k=3, chunk_bytes=20 * 24, query_bytes=3 * 24, per="label")
    want = [(i, None if label is None else str(label), n + 1, j, -s) for i, x, _ in data if i % 20 == 0 for label in (None, 0, 1, 2, 3) for n, (s, j) in enumerate(sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y, own in data if j != i and own == label)[:3])]
    assert sorted(values(got, "query_id", "name", "rank", "vec_id", "score"), key=str) == sorted(want, key=str)


def test_partitions_do_not_change_results(spark):
    rows = [("a", i, f"t{i % 3}", "sequel", "https://anidb.net/anime/1", [f"https://kitsu.app/anime/{i}"]) for i in range(9)]
    ents = spark.createDataFrame([(1, "t0", "https://c/0", ["https://anilist.co/anime/5"])], "pos int, entity_id string, canonical_source string, sources array<string>")
    results = {tuple(sorted(map(str, I.canonicalize_targets(spark.createDataFrame(rows, EDGE).repartition(n), ents).collect()))) for n in (1, 2, 5)}
    assert len(results) == 1


def test_duplicate_titles_of_one_entity(spark):
    row = ("e:1", "manami", "T", "O", ["O", "T", "a", "a"])
    got = B.titles_table(spark.createDataFrame([row], "entity_id string, record_source string, title string, original_title string, synonyms array<string>"))
    assert sorted(values(got, "title_type", "title")) == [("alias", "O"), ("alias", "a"), ("canonical", "T"), ("original", "O")]


def test_running_values_over_ranges(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), rng.randrange(1000), rng.randrange(-5, 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, scope string, at long, v long")
    for rows_per_range in (1, 60, 5000):
        for before in (False, True):
            got = {r.id: (r.total, r.top) for r in P.running(df, "scope", "at", ["at", "id"], {"total": ("sum", df.v), "top": ("max", df.v)}, rows_per_range, before).collect()}
            for i, scope, at, _ in rows:
                own = [v for j, s, a, v in rows if s == scope and ((a, j) < (at, i) or (not before and j == i))]
                assert got[i] == ((sum(own), max(own)) if own else (None, None))
    assert P.running(df.where("false"), "scope", "at", ["at"], {"total": ("sum", df.v)}, 8).count() == 0


def test_ranges_are_even_whatever_outliers_there_are(spark):
    df = spark.range(20_000).selectExpr("if(id = 7, 0, 1700000000000000 + id * id) at", "id").unionByName(spark.sql("select cast(null as long) at, 5L id union all select 9000000000000000, 6L"))
    sizes = {}
    for rows_per_range in (100, 1000, 10_000):
        cuts = P.bounds(df, "at", rows_per_range)
        found = df.withColumn("r", P.range_of(F.col("at"), cuts)).where("r is not null").groupBy("r").agg(F.count("*").alias("n"), F.min("at").alias("low"), F.max("at").alias("high")).orderBy("r").collect()
        assert max(r.n for r in found) < 2 * rows_per_range and all(a.high < b.low for a, b in zip(found, found[1:]))
        sizes[rows_per_range] = len(found)
    assert sizes[100] > 9 * sizes[1000] / 2 > 4 * sizes[10_000]
    assert [r.x for r in spark.createDataFrame([(i,) for i in range(-1, 12)], "a long").select(P.range_of(F.col("a"), [0, 3, 3, 9]).alias("x")).collect()] == [0, 1, 1, 1, 3, 3, 3, 3, 3, 3, 4, 4, 4]


def paced(rows, step):
    """(id, wait, violation) by the plain rule: start at the later of now and next; next is a step later."""
    out, state = [], {}
    for i, p, us in sorted(rows, key=lambda r: (r[2], r[0])):
        free, last = state.get(p, (us, None))
        start = max(us, free)
        state[p] = (start + step, us)
        out.append((i, start - us, last is not None and us - last < step))
    return out


def test_pacing_and_leases_over_ranges(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice("aaab"), rng.choice([0, rng.randrange(3000), 10**6 + rng.randrange(50)])) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, provider string, us long")
    for size in (1, 20, 1000):
        assert sorted(values(N.pacing(df, 40, size), "event_id", "wait_us", "violation")) == sorted(paced(rows, 40))
        held = {i: any(q == p and (t, j) < (us, i) and us < t + 100 for j, q, t in rows) for i, p, us in rows}
        assert dict(values(N.lease_conflicts(df, 100, size), "event_id", "conflict")) == held


def _land(spark, source, *rows):
    spark.createDataFrame(rows, "user_id long, at string").selectExpr("user_id", "timestamp(at) ts").coalesce(1).write.mode("append").parquet(source)


def test_day_windows_by_event_time(spark, tmp_path):
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    requests = lambda df: df.withColumn("provider", F.concat(F.lit("p"), F.col("user_id")))
    def days():
        schema = spark.read.parquet(source).schema
        return sorted(values(N.latest_days(spark, N.daily_budget_events(spark, source, schema, work, requests), 2), "provider", "day", "n", "exhausted"))
    _land(spark, source, (1, "2024-01-01 23:50:00"), (1, "2024-01-01 23:59:59"), (2, "2024-01-01 10:00:00"))
    assert days() == [("p1", "2024-01-01", 2, True), ("p2", "2024-01-01", 1, False)]  # the open day is there
    _land(spark, source, (1, "2024-01-02 00:40:00"))
    assert ("p1", "2024-01-02", 1, False) in days()
    _land(spark, source, (2, "2024-01-01 23:00:00"), (1, "2024-01-02 05:00:00"))  # late, but 1 January is open until 01:00
    assert ("p2", "2024-01-01", 2, True) in days()
    _land(spark, source, (2, "2024-01-01 23:30:00"), (1, "2024-01-02 06:00:00"))  # later than the watermark: dropped
    want = [("p1", "2024-01-01", 2, True), ("p1", "2024-01-02", 3, True), ("p2", "2024-01-01", 2, True)]
    assert days() == want
    assert days() == want  # a restart without new files changes nothing


def test_stream_of_uncached_calls(spark, tmp_path):
    source, work = f"file://{tmp_path}/in", f"file://{tmp_path}/work"
    calls = lambda df: df.withColumn("cache_key", F.concat(F.lit("k"), F.col("user_id")))
    cache = spark.createDataFrame([("k9",), ("k9",)], "cache_key string")
    def found():
        out = N.uncached_stream(spark, source, spark.read.parquet(source).schema, work, calls, cache)
        return sorted((r.cache_key, str(r.ts)) for r in spark.read.parquet(out).collect())
    _land(spark, source, (1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:00"), (9, "2024-01-01 00:00:00"))
    one = [("k1", "2024-01-01 00:00:00")]
    assert found() == one
    _land(spark, source, (1, "2024-01-01 00:30:00"), (2, "2024-01-01 00:10:00"))
    two = [*one, ("k2", "2024-01-01 00:10:00")]
    assert found() == two and found() == two  # within the watermark, and after a restart
    _land(spark, source, (3, "2024-01-01 05:00:00"))
    assert len(found()) == 3
    _land(spark, source, (4, "2024-01-01 01:00:00"), (1, "2024-01-01 05:10:00"))  # too late; and a key whose time is over
    assert found() == sorted([*two, ("k3", "2024-01-01 05:00:00"), ("k1", "2024-01-01 05:10:00")])


def test_negative_amounts_are_rejected(spark):
    calls = spark.createDataFrame([(1, "p", 60), (2, "p", -50), (3, "p", 50), (4, "p", 10), (5, "q", 10), (6, "p", None)], "i long, scope string, cost long")
    got = values(J.budget_admission(calls, 100, "scope", "i", "cost"), "i", "running", "admitted")
    assert sorted(got) == [(1, 60, True), (2, 60, False), (3, 110, False), (4, 120, False), (5, 10, True), (6, 120, False)]


def test_family_of_roots(spark, tmp_path):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("x", "y"), ("z", "z")]
    df, roots = spark.createDataFrame(chain, "src string, dst string"), spark.createDataFrame([("c020", "c020"), ("y", "y"), ("alone", "alone")], "entity_id string, family string")
    for steps in (3, 50):
        got = values(S.family_of(df, roots.where("entity_id <> 'alone'"), f"file://{tmp_path}", steps), "node", "family")
        assert sorted(got) == sorted([(f"c{i:03d}", "c020") for i in range(41)] + [("x", "y"), ("y", "y")])
    assert values(S.family_of(df, roots.where("entity_id = 'alone'"), f"file://{tmp_path}"), "node", "family") == [("alone", "alone")]


def test_embedding_hook_and_cache(spark):
    texts = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, text string")
    first = S.embed(texts.where("id < 2"), spark.createDataFrame([], "cache_key string"), "id", "text")
    again = S.embed(texts, first, "id", "text", embed_fn=lambda t: F.array(F.length(t).cast("double")))
    assert sorted(values(again, "id", "vector"), key=str) == [(2, [1.0]), (3, [None])]
    assert S.embed(texts, first, "id", "text", recipe="other").count() == 3


def test_facets_match_every_pair(spark):
    rows = [("e", "tag", "a", "high"), ("e", "tag", "b", "low"), ("f", "tag", "a", "high"), ("f", "tag", "a", "high"), ("f", "genre", "a", "medium")]
    facets = spark.createDataFrame(rows, "entity_id string, facet_namespace string, facet_key string, confidence_tier string")
    assert values(B.facet_match_all(facets, [("tag", "a"), ("genre", "a")], ["high", "medium"]), "entity_id") == [("f",)]
    assert values(B.facet_match_all(facets, [("tag", "a"), ("tag", "b")], ["high", "medium", "low"]), "entity_id") == [("e",)]


def test_schema_majors(spark):
    schema = "table_name string, schema_version string, compatibility_tier string, recipe_version string"
    before = spark.createDataFrame([("entities", "2", None, None), ("relationships", "core.v1", None, "r1"), ("anime_profile", "1.0", None, "r1"), ("odd", "x", "core", None)], schema)
    after = spark.createDataFrame([("entities", "1", None, "r2"), ("relationships", "core.v10", None, "r2"), ("anime_profile", "2.0", None, "r1"), ("odd", "3", "core", None)], schema)
    got = values(G.compatibility_findings(before, after), "table_name", "rule", "severity")
    assert sorted(got) == [("anime_profile", "schema_major_changed", "warning"), ("relationships", "recipe_changed", "warning"), ("relationships", "schema_major_changed", "error")]


def test_similarity_reasons(spark):
    ents = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"]), ("c", []), ("d", [])], "entity_id string, tags array<string>")
    for c in ("genres", "studios", "creators"):
        ents = ents.withColumn(c, F.array().cast("array<string>"))
    edges = spark.createDataFrame([("a", "c"), ("c", "b"), ("c", "d"), ("a", "d")], "source_entity_id string, target_entity_id string")
    near = spark.createDataFrame([("a", "d", 0.5)], "entity_id string, other_id string, score double")
    got = {r.target_entity_id: (r.candidate_reasons, r.score_dimensions) for r in S.similarity_candidates(ents, edges, ents.where("entity_id = 'a'").select("entity_id"), near).collect()}
    assert got == {"b": (["graph_distance_2", "shared_facets"], {"graph_distance_2": 1.0, "shared_facets": 1.0}), "d": (["vector_neighbour"], {"vector_neighbour": 0.5})}


def plain_search(ents, queries):
    fold = lambda t: " ".join(t.lower().replace("ß", "ss").split()) if t is not None else None
    out = {}
    for q in {q for q in queries if q is not None}:
        k = fold(q)
        for i, title, original, synonyms in ents:
            best, fields = 0, []
            for field, raw in [("title", title), ("original_title", original), *[("synonym", s) for s in synonyms or []]]:
                n = fold(raw)
                if not n:
                    continue
                first = field == "title"
                shared = len(set(k.split(" ")) & set(n.split(" ")))
                score = (100 if first else 96) if n == k else (92 if first else 84) if n.startswith(k) else (88 if first else 80) if k in n else 60 + min(4 * shared, 16) if shared else 0
                if score > best:
                    best, fields = score, [field]
                elif score == best and score and field not in fields:
                    fields.append(field)
            if best:
                out[q, i] = (best, fields)
    return out


def test_search_of_many_queries(spark):
    rng = random.Random(8)
    words = ["red", "Reddish", "ring", "of", "the", "Straße", "a", "ab", "xyz", "Été", "king's", "ringing"]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    ents = [(f"e{i}", make(rng.randrange(1, 4)), rng.choice([None, "", make(2)]), [rng.choice([None, " ", make(3)]) for _ in range(rng.randrange(3))]) for i in range(120)]
    ents.append(("none", "red", None, None))
    queries = ["", " ", "r", "RE", "re d", "ing of", "ring", "d ring", "the straße", "ab", "b", "zzz", "nothing here", None, "Red", "red", "red", "a b c d", "ed ri", "of the ring", "’"] + [make(rng.randrange(1, 5)) for _ in range(60)]
    frame = spark.createDataFrame([(*e, 2000) for e in ents], "entity_id string, title string, original_title string, synonyms array<string>, release_year int")
    found = S.search(frame, spark.createDataFrame([(q,) for q in queries], "query string"))
    got = {(r.query, r.entity_id): (r.score, r.matched_fields) for r in found.collect()}
    assert got == plain_search(ents, queries) and found.count() == len(got)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_search_by_pieces_of_any_length(spark):
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    ents = [(f"e{i}", text(rng.choice([1, 2, 5, 17, 40, 130, 300])), None, [text(9)]) for i in range(60)]
    cut = lambda t: t[(a := rng.randrange(len(t))) : a + rng.choice([1, 2, 3, 5, 11, 16, 31, 129, 200])]
    queries = [cut(rng.choice(ents)[1]) for _ in range(80)] + ["a" * n for n in (1, 2, 3, 4, 7, 130)]
    frame = spark.createDataFrame([(*e, 2000) for e in ents], "entity_id string, title string, original_title string, synonyms array<string>, release_year int")
    got = {(r.query, r.entity_id): (r.score, r.matched_fields) for r in S.search(frame, spark.createDataFrame([(q,) for q in queries], "query string")).collect()}
    assert got == plain_search(ents, queries)


def test_tables_of_unknown_real_size_are_never_broadcast(spark, tmp_path):
    """Files so small that Spark would broadcast them, whatever becomes of their rows."""
    ents = spark.range(50).selectExpr("concat('e', id) entity_id", "'anime' domain", "concat('red ring ', id) title", "cast(null as string) original_title", "array('drama') genres", "array('x', 'y') tags", "array('s') studios", "cast(null as array<string>) synonyms", "2000 release_year")
    ents.write.parquet(f"{tmp_path}/ents")
    spark.range(40).selectExpr("concat('e', id) node", "'e0' family").write.parquet(f"{tmp_path}/family")
    ents, family = spark.read.parquet(f"{tmp_path}/ents"), spark.read.parquet(f"{tmp_path}/family")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    queries = spark.createDataFrame([("red ring 7",), ("drama",)], "query string")
    found = S.search(ents, queries)
    assert "BroadcastExchange" not in plan(found) and found.where("query = 'red ring 7'").count() == 50
    assert "BroadcastExchange" not in plan(S.exclude_family(ents, family)) and S.exclude_family(ents, family).count() == 10
    roots = ents.where("entity_id = 'e3'").select("entity_id").repartition(1)
    shared = S.shared_metadata(ents, "studios", "same_studio", roots, family)
    assert shared.count() == 10 and plan(shared).count("BroadcastHashJoin") <= 1
    spark.range(50).selectExpr("id p_partkey", "cast(id % 50 as int) p_size").write.parquet(f"{tmp_path}/part.parquet")
    assert "BroadcastExchange" not in plan(testbed.graph(spark, str(tmp_path))) and testbed.graph(spark, str(tmp_path)).count() == 49
    concepts = S.concept_search(ents, queries)
    assert "BuildLeft" not in plan(concepts) and concepts.count() == 50


def test_franchise_pairs_without_a_shuffle_of_pairs(spark):
    rows = [(f"e{i}", [f"franchise:{i % 4}", f"franchise:x{i % 3}", "franchise:0", "other"] if i % 2 else [f"franchise:{i % 4}", None]) for i in range(40)]
    df = spark.createDataFrame([*rows, rows[0], ("none", None)], "entity_id string, tags array<string>")
    found = S.franchise_pairs(df)
    held = {e: {t for t in tags if t and t.startswith("franchise:")} for e, tags in rows}
    assert sorted((r.entity_id, r.other_id) for r in found.collect()) == sorted((a, b) for a in held for b in held if a != b and held[a] & held[b])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[: plan.index("Join")]


def test_digest_of_an_order_holds_no_list_of_rows(spark):
    import hashlib

    rows = spark.range(30000).selectExpr("id + 1 place", "concat('é', id) t").repartition(7)
    found = S.ordered_digest(rows, F.col("t"), "place", "node")
    assert tuple(found.first()) == (30000, hashlib.md5("|".join(f"é{i}" for i in range(30000)).encode()).hexdigest())
    assert "collect_list" not in found._jdf.queryExecution().executedPlan().toString()
    assert tuple(S.ordered_digest(rows.where("place < 0"), F.col("t"), "place", "node").first()) == (0, hashlib.md5(b"").hexdigest())


def test_sections_merge_and_number_cards_in_one_deal(spark):
    ents = spark.createDataFrame([(e, f"t{e}", 2000) for e in "abc"], "entity_id string, title string, release_year int")
    edges = spark.createDataFrame([("a", 0, "b", "sequel", "u", ["https://x.example/1"]), ("b", 1, "a", "sequel", "u", []), ("a", 2, "c", "prequel", "u", []), ("a", 3, "gone", "prequel", "u", [])], EDGE)
    found = S.related_sections(ents, edges)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    assert sorted(values(found, "entity_id", "relationship", "place", "other_id", "direction")) == [("a", "prequel", 1, "c", "outgoing"), ("a", "sequel", 1, "b", "bidirectional"), ("b", "sequel", 1, "a", "bidirectional"), ("c", "prequel", 1, "a", "incoming"), ("gone", "prequel", 1, "a", "incoming")]


def test_ordinals_of_one_huge_group(spark):
    rng = random.Random(6)
    rows = [(i, "big" if i % 9 else rng.choice(["s", None]), rng.choice(["anime", "tv", None]), rng.choice([None, 1990, 2000]), f"t{rng.randrange(50)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, family string, domain string, year int, title string").repartition(5)
    order = [F.col("domain"), F.col("year"), F.col("title"), F.col("id")]
    want = {(r.id, r.place) for r in P.ordinals(df, "family", order).collect()}
    for size in (10, 100, 700):
        assert {(r.id, r.place) for r in P.ordinals(df, "family", order, rows_per_range=size).collect()} == want
        keyed = df.withColumn("k", F.struct(*order))
        cuts = P.key_bounds(df, F.struct(*order), size)
        assert len(cuts) > 3000 / size / 3
        if size == 100:
            table = sorted(((d is not None, d or "", y is not None, y or 0, t, i) for i, _, d, y, t in rows))
            marks = [((c[0] is not None), c[0] or "", c[1] is not None, c[1] or 0, c[2], c[3]) for c in cuts]
            edges = [0, *[sum(x < m for x in table) for m in marks], len(table)]
            assert max(b - a for a, b in zip(edges, edges[1:])) < 4 * len(table) / len(edges) and keyed
    assert P.ordinals(df.where("false"), "family", order, rows_per_range=1).count() == 0


def test_values_that_very_many_hold(spark):
    ents = [(f"e{i}", ["Hot "] * (i % 3 == 0) + [f"v{i % 40}", " "], 2000, f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(ents, "entity_id string, tags array<string>, release_year int, title string")
    roots = spark.createDataFrame([("e0",), ("e3",), ("e41",)], "entity_id string")
    got = {(r.entity_id, r.other_id): r.overlap for r in S.shared_values(df, "tags", roots).collect()}
    want = {}
    for r in (0, 3, 41):
        for i in range(3000):
            n = (r % 3 == 0 and i % 3 == 0) + (r % 40 == i % 40)
            if n and i != r:
                want[f"e{r}", f"e{i}"] = n
    assert got == want
    # The hot value's holders are dealt: no partition of the joined rows holds most of them.
    joined = S.join_crowded(df.select(F.col("entity_id").alias("other_id"), F.explode("tags").alias("v")), df.select(F.explode("tags").alias("v")).distinct(), "v", "other_id", S.crowded_keys(df.select(F.explode("tags").alias("v")), "v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in joined.where("v = 'Hot '").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 1000 and len(sizes) >= 3


def test_embedding_by_a_model(spark):
    def counting_model():
        def call(texts):
            if any(t == "bad" for t in texts):
                raise ValueError("no")
            return [[float(len(t))] if t != "none" else None for t in texts]

        return call

    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bad", "ccc", None, "none", "bad", "a"] + ["x" * i for i in range(40)])], "id long, text string")
    names = ("p", "m", "r")
    cache = S.fresh_texts(texts.where("text = 'ccc'"), spark.createDataFrame([], "cache_key string"), "id", "text", *names)
    got = {r.id: (r.vector, (r.error or "").split(":")[0]) for r in S.embed_batches(texts.coalesce(1), cache, "id", "text", counting_model, *names, batch_rows=7).collect()}
    assert set(got) == set(range(47)) - {2}
    assert got[0] == ([1.0], "") and got[1] == got[5] == (None, "ValueError") and got[3] == (None, "TypeError") and got[4] == (None, "TypeError") and got[46] == ([39.0], "")
    assert S.embed_batches(texts.where("false"), cache, "id", "text", counting_model, *names).count() == 0


def test_an_alias_that_very_many_edges_point_to(spark):
    rows = [(f"s{i}", i, "anime:anilist:5" if i % 3 else f"gone{i % 7}", "sequel", f"u{i}", [f"v{i}"]) for i in range(900)] + [("s1", 5000, "t0", "sequel", "u", ["w"]), ("s2", 5001, None, "sequel", "u", [])]
    ents = spark.createDataFrame([(1, "t0", "https://c/0", ["https://anilist.co/anime/5"]), (2, "other", "https://c/1", [])], "pos int, entity_id string, canonical_source string, sources array<string>")
    got = {(r.source_entity_id, r.target_entity_id): (r.pos, r.target_url, r.supporting_urls) for r in I.canonicalize_targets(spark.createDataFrame(rows, EDGE), ents).collect()}
    want = {(s, "t0" if i % 3 else t): (i, "https://c/0" if i % 3 else u, [*v, "https://c/0" if i % 3 else u]) for i, (s, _, t, _, u, v) in enumerate(rows[:900])}
    want["s1", "t0"] = (1, "https://c/0", ["v1", "w", "https://c/0"])
    want["s2", None] = (5001, "u", ["u"])
    assert got == want


def rows_of_tasks(df):
    from pyspark.sql import functions as F

    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_canonical_edges_are_merged_in_bounded_tasks_after_one_shuffle(spark, monkeypatch):
    monkeypatch.setattr("marquee.functions.skew.ROWS_A_TASK", 40)
    rows = [(f"s{i // 2}", i, "anime:anilist:5" if i % 2 else "t0", "sequel", "u", [f"v{i % 2}"]) for i in range(2000)] + [("s1", 3, "t0", "sequel", "u", ["a"]), ("s1", None, "t0", "prequel", "u", ["b"])]
    ents = spark.createDataFrame([(1, "t0", "https://c/0", ["https://anilist.co/anime/5"])], "pos int, entity_id string, canonical_source string, sources array<string>")
    out = I.canonicalize_targets(spark.createDataFrame(rows, EDGE), ents)
    got = {(r.source_entity_id, r.relationship): (r.pos, r.target_url, r.supporting_urls) for r in out.collect()}
    want = {(f"s{i}", "sequel"): (2 * i, "https://c/0", ["v0", "v1", "https://c/0"]) for i in range(1000)}
    assert got == want | {("s1", "sequel"): (2, "https://c/0", ["v0", "a", "v1", "https://c/0"]), ("s1", "prequel"): (None, None, ["b", None])}
    assert max(rows_of_tasks(out)) < 80
    plan = I.canonicalize_targets(spark.createDataFrame(rows, EDGE), ents)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "collect_list" in x and "Aggregate" in x] and plan.count("hashpartitioning(source_entity_id") == 1


def test_edges_of_the_test_tables_lie_in_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr("marquee.functions.skew.ROWS_A_TASK", 500)
    from marquee.functions.skew import join_dealt
    from marquee.plans import testbed

    now, before = testbed.edges(spark, "/root/testdata/sf0.001"), testbed.previous_edges(spark, "/root/testdata/sf0.001")
    assert max(rows_of_tasks(now)) < 1000
    joined = join_dealt(now, before.select("source_entity_id", "target_entity_id", "relationship"), ["source_entity_id", "target_entity_id"])
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2


def test_release_findings_count_keys_in_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr("marquee.functions.skew.ROWS_A_TASK", 40)
    ents = spark.createDataFrame([(f"e{i}", "anime") for i in range(50)], "entity_id string, domain string")
    frames = {
        "entities": ents, "external_ids": spark.createDataFrame([("e1", "manami", "BACKBONE_SOURCE")], "entity_id string, source_id string, source_role string"),
        "relationships": spark.createDataFrame([(f"e{i % 60}", f"e{i % 70}") for i in range(900)] + [(None, "e1")], "source_entity_id string, target_entity_id string"),
        "facets": spark.createDataFrame([(f"f{i}",) for i in range(2000)] + [("f7",), ("f7",), ("f8",), (None,), (None,)], "facet_id string"),
    }
    out = G.release_findings(frames, {}, ["anime"], ["manami"])
    want = [("orphan_source_entity_id", f"e{i}", "error") for i in range(50, 60)] + [("orphan_target_entity_id", f"e{i}", "error") for i in range(50, 70)] + [("repeated_key", f, "warning") for f in ("f7", "f8", None)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    plan = G.release_findings(frames, {}, ["anime"], ["manami"])._jdf.queryExecution().executedPlan().toString()
    assert "51), REPARTITION_BY_NUM" in plan
    assert not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "entity_id" in x]


def test_judged_edges_meet_roles_unsorted(spark):
    edges = spark.createDataFrame([(f"a{i}", i, f"b{i % 3}", "sequel", "u", [f"https://x/{i}"]) for i in range(30)], EDGE)
    decisions = edges.selectExpr("source_entity_id", "target_entity_id", "concat('k', pos) cache_key", "if(pos = 4, 'parse_error', 'ok') status", "relationship judged", "0.95D confidence", "'f' input_fingerprint", "'p' provider", "'m' model", "'r' recipe_version")
    ents = spark.createDataFrame([(f"a{i}", "BACKBONE_SOURCE") for i in range(28)] + [("b0", "BACKBONE_SOURCE"), ("b1", None)], "entity_id string, source_role string")
    out = J.judgment_records(decisions, edges, ents)
    assert sorted(values(out, "judgment_id", "publishable_evidence")) == sorted((f"k{i}", int(i % 3 == 0)) for i in range(28) if i != 4 and i % 3 < 2)
    plan = J.judgment_records(decisions, edges, ents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2 and plan.count("SortMergeJoin") == 1 and "BroadcastHashJoin" not in plan


def preview_rows(spark):
    """Entities in two families (and one of no edge), with edges that count in ``seen`` each time that they are made."""
    seen = spark.sparkContext.accumulator(0)

    def counted(x):
        seen.add(1)
        return x

    ents = spark.createDataFrame([(f"e{i}", "anime" if i % 2 else "tv", f"red ring {i}", None, [], 2000 + i % 3, ["s"], ["c"], ["red"]) for i in range(30)], "entity_id string, domain string, title string, original_title string, synonyms array<string>, release_year int, studios array<string>, creators array<string>, tags array<string>")
    pairs = [(f"e{i}", f"e{i + 1}") for i in range(0, 8)] + [("e5", "e1"), ("e3", "gone"), ("gone", "e12"), ("e4", None), (None, "e7"), ("e20", "e21")]
    rows = [(a, i, b, "sequel" if i % 2 else "related_anime", f"https://anidb.net/anime/{i}", None if i % 3 == 0 else [f"https://anilist.co/anime/{i}"] * (i % 3)) for i, (a, b) in enumerate(pairs)]
    edges = spark.createDataFrame(rows, EDGE).repartition(3)
    return ents, edges.withColumn("source_entity_id", F.udf(counted, "string").asNondeterministic()("source_entity_id")), rows, seen


def test_preview_makes_its_edges_once(spark, tmp_path):
    ents, edges, rows, seen = preview_rows(spark)
    frames = S.preview_frames(ents, edges, "red ring 3", f"file://{tmp_path}")
    family = {f"e{i}" for i in range(9)} | {"e12", "gone"}
    score = {r.pos: r.score for r in E.with_score(spark.createDataFrame(rows, EDGE)).collect()}
    inside = sorted((a, kind, b, score[i]) for a, i, b, kind, _, _ in rows if a in family - {"gone"} and b in family)
    assert values(frames["edges"].orderBy("place"), "place", "source_entity_id", "relationship", "target_entity_id", "confidence") == [(k + 1, *r) for k, r in enumerate(inside)]
    nodes = sorted(family - {"gone"}, key=lambda e: ("anime" if int(e[1:]) % 2 else "tv", 2000 + int(e[1:]) % 3, f"red ring {e[1:]}", e))
    assert values(frames["nodes"].orderBy("place"), "place", "entity_id") == [(k + 1, e) for k, e in enumerate(nodes)]
    assert {r.other_id for r in frames["sections"].where("relationship in ('sequel', 'related_anime')").collect()} == {"e2", "e4"}
    assert all(f.collect() is not None for f in frames.values()) and seen.value == len(rows)
    assert "Exchange" not in frames["edges"]._jdf.queryExecution().executedPlan().toString()


def test_preview_makes_what_is_wanted_only(spark, tmp_path):
    ents, edges, _, _ = preview_rows(spark)
    assert list(S.preview_frames(ents, edges, "red ring 3", f"file://{tmp_path}", wanted=("edges",))) == ["matches", "edges"]
    frames = S.preview_frames(ents, edges, "red ring 3", f"file://{tmp_path}", confidence=False)
    assert frames["edges"].columns == ["place", "source_entity_id", "relationship", "target_entity_id"]
    none = S.preview_frames(ents, edges, "nothing such", f"file://{tmp_path}")
    assert [f.count() for f in none.values()] == [0] * 5


def test_family_of_roots_by_dealt_rims(spark, tmp_path, monkeypatch):
    """Rims too large to broadcast, two roots of one family, ends that are null."""
    from marquee.functions import skew

    for module in (S, skew):
        monkeypatch.setattr(module, "ROWS_A_TASK", 1)
    edges = [("a", "b"), ("c", "b"), ("c", "d"), ("b", "e"), ("x", "y"), ("a", None), (None, "z")]
    roots = spark.createDataFrame([("a", "a"), ("d", "d"), ("x", "x")], "entity_id string, family string")
    got = values(S.family_of(spark.createDataFrame(edges, "src string, dst string"), roots, f"file://{tmp_path}"), "node", "family")
    assert sorted(got) == sorted([(n, f) for n in "abcde" for f in "ad"] + [("x", "x"), ("y", "x")])


def test_places_of_stored_ranges(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, "a", "b", "é"]), rng.choice([None, 1990, 2000])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, name string, year int").repartition(5)
    order = [F.col("name"), F.col("year"), F.col("id")]
    want = {r[0]: k + 1 for k, r in enumerate(sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[2] is not None, r[2] or 0, r[0])))}
    for size in (100, 5000):
        out = P.placed(df, order, f"file://{tmp_path}", 3000, rows_per_range=size)
        assert {r.id: r.place for r in out.collect()} == want and out.columns == [*df.columns, "place"]
    assert P.placed(df.where("id < 0"), order, f"file://{tmp_path}", 0).count() == 0


def test_digest_reads_runs_instead_of_rows(spark):
    import hashlib

    rows = spark.range(0, 30000, 1, 3).where("id not between 12000 and 12999").selectExpr("cast(id + 1 as int) place", "concat('é', id) t")
    runs = S.packed_runs(rows, F.col("t"), "place")
    assert runs.agg(F.sum("n")).first()[0] == 29000 and runs.count() <= 36
    assert tuple(S.ordered_digest(rows, F.col("t"), "place", "edge").first()) == (29000, hashlib.md5("|".join(f"é{i}" for i in range(30000) if not 12000 <= i <= 12999).encode()).hexdigest())
