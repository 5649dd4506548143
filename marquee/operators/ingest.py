"""Candidates to wide entities: slices, validation with one reason each, normalisation, canonical targets, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.functions import shapes as sh
from marquee.functions.skew import crowded_keys, dealt, join_crowded
from marquee.operators import edges as E
from marquee.plans import fixed


def title_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.where(X.fold(F.col(column)).contains(X.fold(F.lit(text))))


def slice_candidates(df: DataFrame, start: int, size: int, limit: int | None = None) -> tuple[DataFrame, int]:
    """Rows of source order [start, start + size) of the first ``limit`` rows, and the next offset."""
    rows, end, _ = slice_of(df, start, size, limit)
    return rows, end


def slice_of(df: DataFrame, start: int, size: int, limit: int | None = None, bucket_rows: int = 200_000) -> tuple[DataFrame, int, int]:
    """The same, and the number of rows in all.

    Order is the column ``pos``; rows may have gaps in it, so an ordinal is counted range by range, not in one task: counts per
    range (a range for every ``bucket_rows`` rows, 256 at least and 65,536 at most, a row each) give each range its first ordinal, and
    only ranges that the slice touches are numbered.
    """
    if start < 0 or size < 1:
        raise ValueError("start must not be negative and size must be positive")
    low, high, n = df.agg(F.min("pos"), F.max("pos"), F.count("*")).first()
    total = n if limit is None else min(n, limit)
    if start > total:
        raise ValueError("start lies beyond the end")
    if not n:
        return df, 0, 0
    width = max(1, -(-(high - low + 1) // min(1 << 16, max(256, n // bucket_rows))))
    bucket = F.floor((F.col("pos") - low) / width).cast("int")
    counts = {r.b: r.n for r in df.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()}
    begin, at = {}, 0
    for b in sorted(counts):
        begin[b] = at
        at += counts[b]
    end = min(start + size, total)
    touched = [b for b in begin if begin[b] < end and begin[b] + counts[b] > start]
    if not touched:
        return df.limit(0), end, n
    firsts = df.sparkSession.createDataFrame([(b, begin[b]) for b in touched], "_b int, _first long")
    own = df.where((F.col("pos") >= low + touched[0] * width) & (F.col("pos") < low + (touched[-1] + 1) * width)).withColumn("_b", bucket)
    ordinal = F.row_number().over(Window.partitionBy("_b").orderBy("pos")) - 1
    numbered = own.withColumn("_i", ordinal).join(F.broadcast(firsts), "_b").withColumn("_o", F.col("_first") + F.col("_i"))
    return numbered.where((F.col("_o") >= start) & (F.col("_o") < end)).drop("_b", "_i", "_first", "_o"), end, n


def parsed_sources(urls: Column) -> Column:
    return F.filter(F.transform(urls, X.parse_source_ref), lambda r: r.isNotNull())


def validate(cands: DataFrame) -> DataFrame:
    """Adds reason and detail (null where accepted): missing fields by name, odd shape, missing year, unsupported source."""
    missing = F.array_sort(F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in ("sources", "status", "title", "type")])))
    odd = ~F.col("type").isin(fixed.MEDIA_TYPES) | ~F.col("status").isin(fixed.STATUSES)
    case = (F.when(F.size(missing) > 0, F.struct(F.lit("missing_required_field").alias("reason"), F.array_join(missing, ",").alias("detail")))
            .when(odd, F.struct(F.lit("missing_required_field").alias("reason"), F.lit("candidate_shape").alias("detail")))
            .when(F.col("year").isNull(), F.struct(F.lit("missing_required_field").alias("reason"), F.lit("animeSeason.year").alias("detail")))
            .when(F.size(parsed_sources(F.col("sources"))) == 0, F.struct(F.lit("unsupported_source_url").alias("reason"), F.lit("sources").alias("detail"))))
    return cands.withColumn("_v", case).withColumn("reason", F.col("_v.reason")).withColumn("detail", F.col("_v.detail")).drop("_v")


CANDIDATE_SHAPE = sh.record({
    "sources": sh.many(sh.string(), True), "title": sh.string(True), "type": sh.string(True, values=fixed.MEDIA_TYPES), "episodes": sh.whole(nullable=True), "status": sh.string(True, values=fixed.STATUSES),
    "animeSeason": sh.record({"season": sh.string(nullable=True), "year": sh.whole(nullable=True)}), "synonyms": sh.many(sh.string()), "relatedAnime": sh.many(sh.string()), "tags": sh.many(sh.string()),
})


def validate_raw(cands: DataFrame) -> DataFrame:
    """Candidates as landed (pos, raw JSON text, others) with reason, detail and fields (null where accepted) and typed columns.

    The rules of ``validate`` on the kinds that the JSON really has: an absent required field is missing; a null or a value of
    another kind, at any depth, is an odd shape, and so is text that is no JSON object. ``fields`` names every field at fault. Other keys are
    let through. Typed columns (title, type, status, year, episodes, sources, synonyms, related, tags) are null in rows of odd or missing fields.
    """
    strings = lambda: F.array().cast("array<string>")
    row = lambda reason, detail, names: F.struct(F.lit(reason).alias("reason"), detail.alias("detail"), names.alias("fields"))
    odd, one = F.lit("candidate_shape"), lambda name: F.array(F.lit(name))

    def judged(j: Column, found: Column) -> Column:
        missing = sh.of_kind(found, sh.MISSING)
        year, sources = F.try_variant_get(j, "$.animeSeason.year", "int"), F.try_variant_get(j, "$.sources", "array<string>")
        return (F.when(found.isNull(), row("missing_required_field", odd, strings()))
                .when(F.exists(found, lambda f: f["fault"] == sh.MISSING), row("missing_required_field", F.array_join(missing, ","), missing))
                .when(F.size(found) > 0, row("missing_required_field", odd, sh.of_kind(found, sh.WRONG)))
                .when(year.isNull(), row("missing_required_field", F.lit("animeSeason.year"), one("animeSeason.year")))
                .when(F.size(parsed_sources(sources)) == 0, row("unsupported_source_url", F.lit("sources"), one("sources"))))

    shaped = lambda j: F.when(F.schema_of_variant(j).startswith("OBJECT"), sh.faults(j, CANDIDATE_SHAPE))
    out = cands.withColumn("_j", F.try_parse_json("raw")).withColumn("_v", sh.bound(F.col("_j"), lambda j: sh.bound(shaped(j), lambda found: judged(j, found))))
    sound = F.col("_v").isNull() | (F.col("_v.detail") == "animeSeason.year") | (F.col("_v.detail") == "sources") & (F.col("_v.reason") == "unsupported_source_url")
    get = lambda path, kind: F.when(sound, F.try_variant_get("_j", f"$.{path}", kind))
    texts = lambda path: F.when(sound, F.coalesce(F.try_variant_get("_j", f"$.{path}", "array<string>"), strings()))
    columns = {"title": get("title", "string"), "type": get("type", "string"), "status": get("status", "string"), "year": get("animeSeason.year", "int"), "episodes": get("episodes", "int"), "sources": texts("sources"), "synonyms": texts("synonyms"), "related": texts("relatedAnime"), "tags": texts("tags")}
    return out.select(*cands.columns, "_v.reason", "_v.detail", "_v.fields", *[v.alias(k) for k, v in columns.items()])


def rejection_summary(validated: DataFrame) -> DataFrame:
    """Candidates per reason; accepted ones under ``accepted``."""
    return validated.groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


def normalize_release(accepted: DataFrame) -> DataFrame:
    """Accepted release candidates as wide entities; every parsed related URL is an edge."""
    refs = parsed_sources(F.col("sources"))
    related = parsed_sources(F.array_distinct("related"))
    out = accepted.withColumn("_refs", refs).withColumn("_c", X.pick_canonical(F.col("_refs")))
    lineage = F.map_from_arrays(F.array(*[F.lit(x) for x in ("title", "episodes", "status", "release_year")]), F.array_repeat(F.array("_c.url"), 4))
    edge = lambda r: F.struct(r["alias_id"].alias("target"), F.lit("related_anime").alias("relationship"), r["url"].alias("target_url"), F.array(r["url"]).alias("supporting_urls"))
    return out.select(
        "pos", F.col("_c.alias_id").alias("entity_id"), F.lit("anime").alias("domain"), F.col("_c.url").alias("canonical_source"), F.lit(fixed.PUBLIC_ROLE).alias("source_role"), "title",
        X.original_title(F.col("synonyms")).alias("original_title"), F.col("type").alias("media_type"), "status", F.col("year").alias("release_year"), X.dedupe_keep_order(F.col("synonyms")).alias("synonyms"),
        F.transform("_refs", lambda r: r["url"]).alias("sources"), F.transform(related, edge).alias("related"), lineage.alias("field_sources"),
    )


def normalize_shows(shows: DataFrame) -> DataFrame:
    """Show payloads as wide entities: id, url, name, type, language, genres, status, premiered, official_site, imdb, tvdb, network, web_channel, episodes."""
    channel = F.coalesce(F.nullif("web_channel", F.lit("")), F.nullif("network", F.lit("")))
    tags = F.concat(F.transform(F.filter("genres", lambda g: F.trim(g) != ""), X.slug), F.array(X.prefixed_tag("language", F.col("language")), X.prefixed_tag("network", channel), X.prefixed_tag("tv_type", F.col("type"))))
    sources = F.array(F.col("url"), F.nullif("official_site", F.lit("")), F.concat(F.lit("https://www.imdb.com/title/"), F.nullif("imdb", F.lit("")), F.lit("/")), F.concat(F.lit("https://thetvdb.com/series/"), F.col("tvdb").cast("string")))
    return shows.select(
        F.concat(F.lit("tv:tvmaze:"), F.col("id").cast("string")).alias("entity_id"), F.lit("tv").alias("domain"), F.col("name").alias("title"), F.coalesce(F.nullif("type", F.lit("")), F.lit("TV")).alias("media_type"),
        F.coalesce(F.nullif("status", F.lit("")), F.lit("UNKNOWN")).alias("status"), F.coalesce(F.left("premiered", F.lit(4)).try_cast("int"), F.lit(0)).alias("release_year"), F.nullif(F.col("episodes"), F.lit(0)).alias("episodes"),
        X.sorted_distinct(sources).alias("sources"), X.sorted_distinct(tags).alias("tags"),
    )


def normalize_movies(records: DataFrame) -> DataFrame:
    """Movie records as wide entities: qid, label, publication_date, imdb_id, genres, directors, series."""
    year = X.year_of(F.col("publication_date"))
    page = F.concat(F.lit("https://www.wikidata.org/wiki/"), F.col("qid"))
    tags = F.concat(F.transform(F.filter("genres", lambda g: F.trim(g) != ""), X.slug), F.transform("series", lambda s: F.concat(F.lit("franchise:"), X.slug(s))))
    return records.select(
        F.concat(F.lit("movie:wikidata:"), F.col("qid")).alias("entity_id"), F.lit("movie").alias("domain"), F.col("label").alias("title"), F.lit("MOVIE").alias("media_type"), F.when(year > 0, "RELEASED").otherwise("UNKNOWN").alias("status"), F.coalesce(year, F.lit(0)).alias("release_year"),
        X.sorted_distinct(F.array(page, F.concat(F.lit("https://www.imdb.com/title/"), F.nullif("imdb_id", F.lit("")), F.lit("/")))).alias("sources"), F.col("directors").alias("creators"), X.sorted_distinct(tags).alias("tags"),
    )


def movie_rollup(bindings: DataFrame) -> DataFrame:
    """One row per qid of result bindings: smallest label, date and runtime, and sorted distinct names joined by pipes."""
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")
    return bindings.groupBy("qid").agg(F.min("label").alias("label"), F.min("publication_date").alias("publication_date"), F.min("runtime").alias("runtime"), joined("genre").alias("genres"), joined("director").alias("directors"))


def best_title_result(results: DataFrame) -> DataFrame:
    """Per search text the best result: exact title, then more episodes, then later year; the first of equals. Without year or URL none."""
    exact = F.exists(F.array("romaji", "english", "native"), lambda t: X.fold(t) == X.fold(F.col("search")))
    order = Window.partitionBy("search").orderBy(F.desc(F.coalesce(exact, F.lit(False))), F.desc(F.coalesce("episodes", F.lit(0))), F.desc(F.coalesce("year", F.lit(0))), "pos")
    return results.withColumn("_i", F.row_number().over(order)).where("_i = 1 and year is not null and url is not null").drop("_i")


def aliases(ents: DataFrame) -> DataFrame:
    """(alias_id, entity_id, canonical_source): own ids and ids parsed from source URLs; the later entity of an alias wins."""
    every = ents.select("pos", "entity_id", "canonical_source", F.explode(F.array_distinct(F.concat(F.array("entity_id"), F.transform(parsed_sources(F.col("sources")), lambda r: r["alias_id"])))).alias("alias_id"))
    return every.groupBy("alias_id").agg(F.max(F.struct("pos", "entity_id", "canonical_source")).alias("s")).select("alias_id", "s.entity_id", "s.canonical_source")


def canonicalize_targets(edges: DataFrame, ents: DataFrame) -> DataFrame:
    """Alias targets become canonical ids and URLs; edges are then merged by (source, target, type), with all URLs and the target's. Targets of very many edges are dealt over several tasks.

    Edges are merged in windows over tasks of bounded rows: lists gathered before the shuffle hold an edge or two each, and sorting them there spills.
    They are dealt without their type, which may be a constant that Spark takes out of the window.
    """
    total, top = edges.groupBy("target_entity_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    known = aliases(ents).select(F.col("alias_id").alias("target_entity_id"), F.col("entity_id").alias("_id"), F.col("canonical_source").alias("_url"))
    out = join_crowded(edges, known, "target_entity_id", "source_entity_id", crowded_keys(edges, "target_entity_id", total, top), "left")
    out = out.select("source_entity_id", "pos", F.coalesce("_id", "target_entity_id").alias("target_entity_id"), "relationship", F.coalesce("_url", "target_url").alias("target_url"), "supporting_urls")
    key = ["source_entity_id", "target_entity_id", "relationship"]
    order = Window.partitionBy(*key).orderBy("pos", "supporting_urls")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = dealt(out, total, *key[:2]).select(*key, F.row_number().over(order).alias("_i"), F.min("pos").over(whole).alias("pos"), F.min_by("target_url", "pos").over(whole).alias("target_url"), F.collect_list("supporting_urls").over(whole).alias("all")).where("_i = 1")
    return merged.withColumn("supporting_urls", F.array_distinct(F.concat(F.flatten("all"), F.array("target_url")))).drop("all", "_i")


def enrich_relations(edges: DataFrame, feed: DataFrame) -> DataFrame:
    """Retypes ``related_anime`` edges that the feed (source_entity_id, target_entity_id, pos, relation_type, target_format, urls) knows; the last feed row of a pair counts."""
    last = feed.groupBy("source_entity_id", "target_entity_id").agg(F.max_by(F.struct("relation_type", "target_format", "urls"), "pos").alias("f"))
    out = edges.join(last, ["source_entity_id", "target_entity_id"], "left")
    rule = E.relation_rule(F.col("f.relation_type"), F.col("f.target_format"))["relationship"]
    use = (F.col("relationship") == "related_anime") & F.col("f").isNotNull() & rule.isNotNull()
    out = out.withColumn("_use", F.coalesce(use, F.lit(False)))
    return out.withColumn("supporting_urls", F.when(F.col("_use"), F.array_distinct(F.concat("supporting_urls", "f.urls"))).otherwise(F.col("supporting_urls"))).withColumn("relationship", F.when(F.col("_use"), rule).otherwise(F.col("relationship"))).drop("f", "_use")


def enrich_metadata(ents: DataFrame, feed: DataFrame, key: str) -> DataFrame:
    """Feed values (key, genres, studios, creators) replace an anime's own where they are not empty; their lineage is added."""
    names = ("genres", "studios", "creators")
    renamed = feed.select(key, *[F.col(c).alias(f"_{c}") for c in names])
    out = ents.join(renamed, key, "left")
    fresh = {c: (F.col("domain") == "anime") & (F.size(F.coalesce(f"_{c}", F.array().cast("array<string>"))) > 0) for c in names}
    added = F.map_from_entries(F.array_compact(F.array(*[F.when(fresh[c], F.struct(F.lit(c).alias("k"), F.array("canonical_source").alias("v"))) for c in names])))
    out = out.withColumn("field_sources", X.merge_lineage(F.col("field_sources"), added))
    return out.withColumns({c: F.when(fresh[c], F.col(f"_{c}")).otherwise(F.col(c)) for c in names}).drop(*[f"_{c}" for c in names])


def first_requests(ids: DataFrame, key: str, order: str) -> DataFrame:
    """Each id once, at its first place."""
    return ids.groupBy(key).agg(F.min(order).alias("first_at"))
