"""Title search, families, sections, neighbours, concepts and similarity over wide entities and edges."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.functions.rounds import forget, kept
from marquee.functions.skew import ROWS_A_TASK, crowded_keys, join_counted, join_crowded, join_dealt
from marquee.operators import edges as E
from marquee.operators import prefixes as P
from marquee.plans import fixed


#: Lengths of the pieces that names are indexed by; a query is looked up by pieces of the greatest length that fits it.
PIECES = (0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128)


def title_names(ents: DataFrame) -> DataFrame:
    """(entity_id, title, release_year, pos, field, name): each folded name of an entity that isn't empty."""
    name = lambda kind, v: F.struct(F.lit(kind).alias("field"), X.fold(v).alias("name"))
    names = F.concat(F.array(name("title", F.col("title")), name("original_title", F.col("original_title"))), F.transform(F.coalesce("synonyms", F.array().cast("array<string>")), lambda s: name("synonym", s)))
    rows = ents.select("entity_id", "title", "release_year", F.posexplode(names).alias("pos", "n"))
    return rows.select("entity_id", "title", "release_year", "pos", "n.field", "n.name").where("name <> ''")


def pieces(text: Column, size: Column) -> Column:
    """Distinct substrings of ``size`` characters; none of a shorter text, the empty one for size 0."""
    starts = F.sequence(F.lit(1), F.when(size == 0, F.lit(1)).otherwise(F.length(text) - size + 1))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))).otherwise(F.array().cast("array<string>"))


def name_candidates(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(query, q, name): rows of ``texts`` (distinct names) beside each row of ``keys`` (query, q) that they may match, by joins on words and pieces; each pair once.

    A match shares a word with the query or holds it whole. One that holds a query of three words or more shares its inner words. Of
    shorter queries the rarest piece is looked up (by a sixteenth of the names: which piece it is changes no result), and the match confirmed.
    Pieces are as long as the query allows (see PIECES), so that a long query meets few names beside its matches; names give pieces of those
    lengths only that some query asks for. The empty query is held by every name.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))
    by_word = join_dealt(texts.withColumn("key", F.explode(words("name"))), keys.withColumn("key", F.explode(words("q"))), "key").drop("key")
    size = F.array_max(F.filter(F.array(*[F.lit(n) for n in PIECES]), lambda n: n <= F.length("q")))
    short = keys.where(F.size(F.split("q", " ")) <= 2).withColumn("size", size)
    asked = F.array(*[F.lit(r.size) for r in short.select("size").distinct().orderBy("size").collect()]).cast("array<int>")
    short = short.withColumn("key", F.explode(pieces(F.col("q"), F.col("size")))).drop("size")
    held = lambda df: df.withColumn("key", F.explode(F.flatten(F.transform(asked, lambda n: pieces(F.col("name"), n)))))
    counts = join_dealt(held(texts.where(F.pmod(F.xxhash64("name"), F.lit(16)) == 0)), short.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
    rarest = join_dealt(short, counts, "key", "left").groupBy("query", "q").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("r")).select("query", "q", F.col("r.key").alias("key"))
    by_piece = join_dealt(held(texts), rarest, "key").drop("key").where(F.contains("name", "q"))
    return by_word.unionByName(by_piece).select("query", "q", "name").distinct()


def search(ents: DataFrame, queries: DataFrame) -> DataFrame:
    """query, entity_id, title, release_year, score and matched_fields of every entity that a query's text matches.

    Exact, prefix and substring matches of a title score above those of other names; else shared words count. Queries (a column
    ``query``) may be many: they meet distinct names by joins on an index of words and pieces, never all with all, and only the matches
    meet the entities. A query that comes more than once counts once, null never. A query of a word that very many names hold gives as many rows: that is the result.
    """
    keys = queries.select("query", X.fold(F.col("query")).alias("q")).where("q is not null").distinct()
    names = title_names(ents)
    found = join_dealt(names, name_candidates(names.select("name").distinct(), keys), "name")
    title, name, q = F.col("field") == "title", F.col("name"), F.col("q")
    overlap = F.least(F.size(F.array_intersect(F.split(q, " "), F.split(name, " "))) * 4, F.lit(16))
    score = (F.when(name == q, F.when(title, 100).otherwise(96))
             .when(name.startswith(q), F.when(title, 92).otherwise(84))
             .when(name.contains(q), F.when(title, 88).otherwise(80))
             .otherwise(overlap + 60))
    best = found.groupBy("query", "entity_id", "title", "release_year").agg(F.array_sort(F.collect_set(F.struct(score.alias("score"), "pos", "field"))).alias("s"))
    best = best.withColumn("score", F.array_max(F.transform("s", lambda x: x["score"])))
    fields = F.array_distinct(F.transform(F.filter("s", lambda x: x["score"] == F.col("score")), lambda x: x["field"]))
    return best.select("query", "entity_id", "title", "release_year", "score", fields.alias("matched_fields"))


def top(found: DataFrame, order: list, limit: int, per: list[str]) -> DataFrame:
    """The first ``limit`` rows of each ``per`` group in the stated order, with their rank."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*per).orderBy(*order))).where(F.col("rank") <= limit)


def search_order() -> list:
    return [F.desc("score"), "release_year", X.fold(F.col("title")), "entity_id"]


def families(edges: DataFrame, folder: str, most_rounds: int = 100) -> DataFrame:
    """(node, family): connected components of undirected (src, dst) edges; family is the smallest id.

    Labels spread along edges and then jump to their label's label, so rounds grow with the logarithm of a
    chain's length (100 stand for more nodes than there can be). Each round is a table in ``folder``, which driver and
    executors share; the write counts the labels that changed, and the round before is deleted. Nodes of very many edges are dealt over several tasks.
    """
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()
    both, _ = kept(both, folder, "family")
    label, _ = kept(both.groupBy("src").agg(F.least("src", F.min("dst")).alias("family")).withColumnRenamed("src", "node"), folder, "family")
    crowded = crowded_keys(both, "dst")
    for _ in range(most_rounds):
        near = join_crowded(both, label.select(F.col("node").alias("dst"), "family"), "dst", "src", crowded, dealt=True).groupBy("src").agg(F.min("family").alias("near"))
        step = join_dealt(label, near.withColumnRenamed("src", "node"), "node").select("node", F.least("family", "near").alias("next"), "family")
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved, changes = kept(join_dealt(step, jump, "next", "left").select("node", F.least(F.coalesce("far", "next"), "next").alias("family"), F.col("family").alias("was")), folder, "family", F.col("family") != F.col("was"))
        forget(label)
        label = moved
        if not changes:
            forget(both)
            return label.select("node", "family")
    raise RuntimeError("families did not settle")


def family_graph(ents: DataFrame, edges: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (members with an entity row) and edges from such nodes to any member of the same family, with confidence."""
    nodes = join_dealt(ents, members.withColumnRenamed("node", "entity_id"), "entity_id")
    own = nodes.select(F.col("entity_id").alias("source_entity_id"), "family")
    inside = join_dealt(join_dealt(edges, own, "source_entity_id"), members.select(F.col("node").alias("target_entity_id"), F.col("family").alias("_f")), "target_entity_id").where("family = _f")
    return nodes, E.with_score(inside).select("family", "source_entity_id", "target_entity_id", "relationship", F.col("score").alias("confidence"))


def incoming(edges: DataFrame) -> DataFrame:
    """Edges seen from their target, marked bidirectional where the reverse edge of the same type exists."""
    back = edges.select(F.col("source_entity_id").alias("target_entity_id"), F.col("target_entity_id").alias("source_entity_id"), "relationship", F.lit(True).alias("back")).distinct()
    joined = edges.join(back, ["source_entity_id", "target_entity_id", "relationship"], "left")
    return joined.withColumn("direction", F.when(F.col("back"), "bidirectional").otherwise("incoming")).drop("back")


def merge_cards(cards: DataFrame) -> DataFrame:
    """One card per (entity, other, relationship): the last outgoing one, else the first incoming one. One aggregation."""
    keys = ("entity_id", "other_id", "relationship")
    rest = ["pos", *[c for c in cards.columns if c not in (*keys, "direction", "pos")]]
    side = lambda name: F.when(F.col("direction") == name, F.struct(*rest))
    out = cards.groupBy(*keys).agg(F.max(side("outgoing")).alias("_out"), F.min(side("incoming")).alias("_in"))
    direction = F.when(F.col("_in").isNull(), "outgoing").when(F.col("_out").isNull(), "incoming").otherwise("bidirectional")
    return out.select(*keys, direction.alias("direction"), F.coalesce("_out", "_in").alias("_c")).select(*keys, "direction", "_c.*")


def related_sections(ents: DataFrame, edges: DataFrame) -> DataFrame:
    """Per entity and relationship its related entities in order of confidence, year, folded title and id. Edges are read once: each gives a card to both its ends."""
    scored = E.with_score(edges)
    card = lambda own, other, direction: F.struct(F.col(own).alias("entity_id"), F.col(other).alias("other_id"), F.lit(direction).alias("direction"))
    ends = F.array(card("source_entity_id", "target_entity_id", "outgoing"), card("target_entity_id", "source_entity_id", "incoming"))
    cards = scored.select(F.explode(ends).alias("c"), "relationship", "score", "pos").select("c.*", "relationship", "score", "pos")
    other = ents.select(F.col("entity_id").alias("other_id"), "title", "release_year")
    cards = join_dealt(cards.where("direction = 'outgoing' or entity_id <> other_id"), other, "other_id")
    # Dealt once for both: cards are merged where their section is numbered.
    cards = merge_cards(cards.repartition("entity_id", "relationship"))
    order = Window.partitionBy("entity_id", "relationship").orderBy(F.desc("score"), "release_year", X.fold(F.col("title")), "other_id")
    return cards.withColumn("place", F.row_number().over(order)).select("entity_id", "relationship", "place", "other_id", "direction", F.col("score").alias("confidence"))


def shared_values(ents: DataFrame, column: str, roots: DataFrame | None = None) -> DataFrame:
    """(entity_id, other_id, overlap): entities that share folded values of an array column.

    ``roots`` (entity_id) are joined to the index of values, so a value makes roots x holders rows. Without
    roots every entity is one: then a value held by most entities makes the square of their number, and the
    caller should name roots instead. Values of very many holders are dealt over several tasks.
    """
    index = ents.select("entity_id", F.explode(F.array_distinct(F.transform(F.filter(column, lambda v: F.trim(v) != ""), X.fold))).alias("v"))
    left = index if roots is None else index.join(roots.select("entity_id"), "entity_id", "left_semi")
    holders = index.select(F.col("entity_id").alias("other_id"), "v")
    pairs = join_crowded(holders, left, "v", "other_id", crowded_keys(holders, "v"), dealt=True).where("entity_id <> other_id")
    return pairs.groupBy("entity_id", "other_id").agg(F.count("*").alias("overlap"))


def shared_metadata(ents: DataFrame, column: str, relationship: str, roots: DataFrame, family: DataFrame) -> DataFrame:
    """Entities outside a root's family that share studios or creators, in the order of the section."""
    found = join_dealt(shared_values(ents, column, roots), family.select(F.col("node").alias("entity_id"), F.col("family").alias("f")), "entity_id", "left")
    found = join_dealt(found, family.select(F.col("node").alias("other_id"), F.col("family").alias("g")), "other_id", "left")
    found = found.where("f is null or g is null or f <> g")
    other = ents.select(F.col("entity_id").alias("other_id"), "title", "release_year")
    score = F.lit(fixed.BASE_CONFIDENCE[relationship])
    placed = P.ordinals(join_dealt(found, other, "other_id"), "entity_id", [-F.col("overlap"), F.col("release_year"), X.fold(F.col("title")), F.col("other_id")])
    return placed.select("entity_id", F.lit(relationship).alias("relationship"), "place", "other_id", "overlap", score.alias("confidence"))


def tag_score(n: Column, u: Column) -> Column:
    """n + n / u to two decimals, halves up, in whole numbers so that it sorts alike everywhere."""
    return F.floor((n * (u + 1) * 200 + u) / (u * 2)).cast("long") / 100


def tag_neighbours(ents: DataFrame, roots: DataFrame, limit: int, family: DataFrame | None = None) -> DataFrame:
    """Per root the ``limit`` entities of most shared folded tags; nodes of ``family`` are left out."""
    sizes = ents.select("entity_id", F.size(F.array_distinct(F.transform("tags", X.fold))).cast("long").alias("n_tags"))
    pairs = join_dealt(shared_values(ents, "tags", roots), sizes, "entity_id")
    pairs = join_dealt(pairs, sizes.select(F.col("entity_id").alias("other_id"), F.col("n_tags").alias("m_tags")), "other_id")
    if family is not None:
        pairs = join_dealt(pairs, family.select(F.col("node").alias("other_id")).distinct(), "other_id", "left_anti")
    pairs = pairs.withColumn("score", tag_score(F.col("overlap"), F.col("n_tags") + F.col("m_tags") - F.col("overlap")))
    other = ents.select(F.col("entity_id").alias("other_id"), "title", "release_year")
    ranked = top(join_dealt(pairs, other, "other_id"), [F.desc("score"), F.desc("overlap"), "release_year", X.fold(F.col("title")), "other_id"], limit, ["entity_id"])
    return ranked.select("entity_id", "rank", "other_id", "overlap", "score")


def parse_concept(text: Column) -> Column:
    """struct(genres, tags, notes) that a query text asks for, by substring."""
    t = X.fold(F.replace(text, F.lit("/"), F.lit(" ")))
    some = lambda words: [t.contains(w) for w in words]
    either = lambda words: some(words)[0] if len(words) == 1 else some(words)[0] | some(words)[1]
    genres = F.array_compact(F.array(*[F.when(t.contains(w), g) for w, g in fixed.GENRE_WORDS.items()]))
    none = F.array().cast("array<string>")
    tags = F.array_distinct(F.concat(*[F.when(either(words), F.array(*[F.lit(x) for x in mapped])).otherwise(none) for words, mapped in fixed.TAG_RULES]))
    notes = F.array_compact(F.array(*[F.when(either(words), note) for words, note in fixed.CONCEPT_NOTES]))
    return F.struct(genres.alias("genres"), tags.alias("tags"), notes.alias("notes"))


def concept_search(ents: DataFrame, queries: DataFrame) -> DataFrame:
    """Anime that match the genres and tags of a query, with score and rationale; tags must match where asked for.

    The genres and tags of the queries are joined to those of the entities, and a pair that meets more than once counts once. Each query matches a
    large share of the entities, so queries are few beside them: they are broadcast, never the entities.
    """
    filters = queries.select("query", parse_concept(F.col("query")).alias("c")).select("query", "c.genres", "c.tags")
    base = ents.where("domain = 'anime'").select("entity_id", "title", "release_year", F.transform("genres", X.fold).alias("g"), F.transform("tags", X.fold).alias("t"))
    values = lambda kind, c: F.transform(F.filter(c, lambda x: x.isNotNull()), lambda x: F.struct(F.lit(kind).alias("kind"), X.fold(x).alias("value")))
    met = lambda df, g, t: df.withColumn("m", F.explode(F.array_distinct(F.concat(values("g", g), values("t", t)))))
    pairs = met(base.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("g", "t")}), "g", "t").join(F.broadcast(met(filters, "genres", "tags")), "m").drop("m").dropDuplicates(["query", "entity_id"])
    pairs = pairs.withColumn("matched_genres", F.filter("genres", lambda x: F.array_contains("g", X.fold(x)))).withColumn("matched_tags", F.filter("tags", lambda x: F.array_contains("t", X.fold(x))))
    pairs = pairs.where((F.size("tags") == 0) | (F.size("matched_tags") > 0))
    ng, nt = F.size("matched_genres"), F.size("matched_tags")
    score = F.round(ng * 3.0 + nt * 2.0 + F.least(F.size("t"), F.lit(20)) * 0.01 + F.when((ng > 0) & (nt > 0), 0.5).otherwise(0.0), 2)
    part = lambda head, a, n: F.when(n > 0, F.concat(F.lit(head), F.array_join(a, ", ")))
    rationale = F.concat_ws("; ", part("genre match: ", F.col("matched_genres"), ng), part("tag match: ", F.col("matched_tags"), nt))
    return pairs.select("query", "entity_id", "title", "release_year", score.alias("score"), nt.alias("n_tags"), rationale.alias("rationale"))


def concept_order() -> list:
    return [F.desc("score"), F.desc("n_tags"), "release_year", X.fold(F.col("title")), "entity_id"]


def concept_rank_order() -> list:
    """Remote concept results: most genres, most tags, greatest strength, best average score; the first of equals."""
    return [F.desc(F.size("matched_genres")), F.desc(F.size("matched_tags")), F.desc("strength"), F.desc(F.coalesce("score", F.lit(0))), "pos"]


def concept_rank(media: DataFrame) -> DataFrame:
    """Remote concept results (genres, tags with ranks, wanted genres and tags): matches, strength, title and rationale."""
    genres = F.filter("wanted_genres", lambda g: F.array_contains("genres", g))
    tags = F.filter("wanted_tags", lambda t: F.exists("tags", lambda x: x["name"] == t))
    strength = F.aggregate(F.filter("tags", lambda x: F.array_contains(F.col("wanted_tags"), x["name"])), F.lit(0), lambda s, x: s + F.coalesce(x["rank"], F.lit(0)))
    part = lambda head, a: F.when(F.size(a) > 0, F.concat(F.lit(head), F.array_join(a, ", ")))
    rationale = F.concat_ws("; ", part("genre match: ", genres), part("tag match: ", tags), F.when(F.col("score").isNotNull(), F.concat(F.lit("AniList score "), "score")))
    kept = [c for c in ("pos", "score") if c in media.columns]
    return media.select("id", *kept, F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("romaji", "english", "native")], F.col("id").cast("string")).alias("title"), genres.alias("matched_genres"), tags.alias("matched_tags"), strength.alias("strength"), F.coalesce(F.nullif(rationale, F.lit("")), F.lit("matched AniList filters")).alias("rationale"))


def family_of(edges: DataFrame, roots: DataFrame, folder: str, most_steps: int = 12) -> DataFrame:
    """(node, family) of every node that the roots (entity_id, family) reach along undirected (src, dst) edges, which should be a stored table: each step reads it.

    Steps outwards from the roots only, and counts each rim as it is written: edges are dealt for a large rim only. A family that is
    not whole after ``most_steps`` comes from ``families``, which doubles its reach.
    """
    whole = edges.select("src", "dst").where("src is not null and dst is not null")
    ends = F.array(F.struct(F.col("dst").alias("node"), F.col("_a").alias("family")), F.struct(F.col("src").alias("node"), F.col("_b").alias("family")))
    found, total = kept(roots.select(F.col("entity_id").alias("node"), "family"), folder, "family", F.lit(True))
    rim, fresh = found, total
    for _ in range(most_steps):
        a, b = (rim.select(F.col("node").alias(end), F.col("family").alias(name)) for end, name in (("src", "_a"), ("dst", "_b")))
        if fresh <= ROWS_A_TASK:  # one reading for both ends
            met = join_counted(join_counted(whole, a, fresh, "src", "left"), b, fresh, "dst", "left").where("_a is not null or _b is not null")
            near = met.select(F.explode(ends).alias("e")).select("e.*").where("family is not null")
        else:
            near = join_counted(whole, a, fresh, "src").select(F.col("dst").alias("node"), F.col("_a").alias("family")).unionByName(join_counted(whole, b, fresh, "dst").select(F.col("src").alias("node"), F.col("_b").alias("family")))
        near = near.distinct()
        rim, fresh = kept(join_counted(near, found, total, ["node", "family"], "left_anti"), folder, "family", F.lit(True))
        if not fresh:
            forget(rim)
            return found
        found, total = found.unionByName(rim), total + fresh
    every = families(edges, folder)
    own = every.join(roots.select(F.col("entity_id").alias("node"), F.col("family").alias("root")), "node").select("family", "root").distinct()
    return every.join(own, "family").select("node", F.col("root").alias("family"))


def preview_frames(ents: DataFrame, edges: DataFrame, text: str, folder: str, limit: int = 5, wanted: tuple[str, ...] = ("nodes", "edges", "sections", "tag_neighbours"), confidence: bool = True) -> dict[str, DataFrame]:
    """The preview of a text as frames, so that a family of any size stays distributed: matches (rank, entity_id, score, matched_fields), nodes (place, entity_id)
    and edges (place, source_entity_id, relationship, target_entity_id, confidence) of the chosen entity's family, sections (relationship, place,
    other_id, confidence) and tag_neighbours (rank, other_id, overlap, score). Beside the matches only ``wanted`` ones are made, and edges without ``confidence`` are not scored.

    The chosen entity is the best match. Sections hold related entities by relationship, and entities outside the family that share studios or creators.
    Edges are made once and stored: the steps to the family, its edges and the sections read what was written.
    """
    queries = ents.sparkSession.createDataFrame([(text,)], "query string")
    hits, _ = kept(top(search(ents, queries), search_order(), limit, ["query"]).select("query", "rank", "entity_id", "score", "matched_fields"), folder, "hits")
    frames = {"matches": hits}
    chosen = F.broadcast(hits.where("rank = 1").select("entity_id"))  # one row at most
    # A target's page counts only where no other supports the edge.
    page = F.when(F.size("supporting_urls") > 0, None).otherwise(F.col("target_url")).alias("target_url")
    links, _ = kept(edges.select("source_entity_id", "pos", "target_entity_id", "relationship", page, "supporting_urls"), folder, "edges")
    family = family_of(links.select(F.col("source_entity_id").alias("src"), F.col("target_entity_id").alias("dst")), chosen.withColumn("family", F.col("entity_id")), folder)
    if "nodes" in wanted or "edges" in wanted:
        nodes, count = kept(join_counted(ents.select("entity_id", "domain", "release_year", "title"), family.select(F.col("node").alias("entity_id")), family.count(), "entity_id"), folder, "nodes", F.lit(True))
    if "nodes" in wanted:
        frames["nodes"] = P.placed(nodes, node_keys(), folder, count).select("place", "entity_id")
    if "edges" in wanted:
        # The family is whole, so an edge of a member leads to members.
        inside = join_counted(links.where("target_entity_id is not null"), nodes.select(F.col("entity_id").alias("source_entity_id")), count, "source_entity_id", "left_semi")
        inside = E.with_score(inside).withColumnRenamed("score", "confidence") if confidence else inside
        columns = ["source_entity_id", "relationship", "target_entity_id", *["confidence"] * confidence]
        inside, count = kept(inside.select(*columns), folder, "inside", F.lit(True))
        frames["edges"] = P.placed(inside, edge_keys(), folder, count).select("place", *columns)
    if "sections" in wanted:
        root = F.lit((chosen.first() or [None])[0])
        mine = links.where((F.col("source_entity_id") == root) | (F.col("target_entity_id") == root))  # one reading for both ends
        sections = related_sections(ents, mine).join(chosen, "entity_id", "left_semi").select("relationship", "place", "other_id", "confidence")
        for column, relationship in (("studios", "same_studio"), ("creators", "same_creator")):
            sections = sections.unionByName(shared_metadata(ents, column, relationship, chosen, family).select("relationship", "place", "other_id", "confidence"))
        frames["sections"] = sections
    if "tag_neighbours" in wanted:
        frames["tag_neighbours"] = tag_neighbours(ents, chosen, limit, family).select("rank", "other_id", "overlap", "score")
    return frames


def query_preview(ents: DataFrame, edges: DataFrame, text: str, folder: str, limit: int = 5) -> DataFrame:
    """``preview_frames`` as one row for a text, with arrays in their stated orders: for a reader, and families that fit a row. No match: no row."""
    return preview_row(preview_frames(ents, edges, text, folder, limit))


def preview_row(frames: dict[str, DataFrame]) -> DataFrame:
    """One row of the frames of a preview, those other than ``matches`` as arrays of their names."""
    hits = frames["matches"]
    out = hits.groupBy("query").agg(F.max(F.when(F.col("rank") == 1, F.col("entity_id"))).alias("selected_entity_id"), F.array_sort(F.collect_list(F.struct("rank", "entity_id", "score", "matched_fields"))).alias("matches"))
    for name, frame in frames.items():  # one row each
        if name != "matches":
            out = beside(out, frame.agg(F.array_sort(F.collect_list(F.struct(*frame.columns))).alias(name)))
    return out


def beside(out: DataFrame, row: DataFrame) -> DataFrame:
    """Rows with the columns of a table of one row."""
    return out.withColumn("_one", F.lit(1)).join(row.withColumn("_one", F.lit(1)), "_one").drop("_one")


def packed_runs(frame: DataFrame, text: Column, place: str) -> DataFrame:
    """(at, n, size, packed): for each run of consecutive places, 1024 rows at most, its first place, rows and joined texts (by pipes), packed where the rows lie."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            if batch.num_rows:
                at = batch.column(1).to_numpy()
                starts = np.union1d(np.flatnonzero(np.diff(at) != 1) + 1, np.arange(0, len(at), 1024))
                ends = np.append(starts, len(at))
                texts = [t.as_buffer() for t in pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), batch.column(0)), "|")]
                yield pa.RecordBatch.from_arrays([pa.array(at[starts], pa.int64()), pa.array(np.diff(ends), pa.int32()), pa.array([t.size for t in texts], pa.int64()), pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())], ["at", "n", "size", "packed"])

    return frame.select(text.alias("t"), place).mapInArrow(packed, "at long, n int, size long, packed binary")


def ordered_digest(frame: DataFrame, text: Column, place: str, name: str) -> DataFrame:
    """One row: {name}_count, and {name}s_md5 of the rows' texts in the order of ``place`` (whole numbers), joined by pipes. The digest of an order is one stream:
    one task sorts and reads packed runs, not rows, and holds the text of one run at a time. Rows that lie in the order of their places make long runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, n, digest = pa.Codec("zstd"), 0, hashlib.md5()
        for batch in batches:
            for rows, size, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                digest.update(b"|" if n else b"")
                digest.update(codec.decompress(text, size))
                n += rows
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([digest.hexdigest()])], ["n", "md5"])

    found = packed_runs(frame, text, place).repartition(1).sortWithinPartitions("at").select("n", "size", "packed").mapInArrow(run, "n int, md5 string")
    return found.agg(F.coalesce(F.max("n"), F.lit(0)).alias(f"{name}_count"), F.coalesce(F.max("md5"), F.md5(F.lit(""))).alias(f"{name}s_md5"))


def node_keys() -> list[Column]:
    """The order of a family's nodes: domain, year, folded title and id."""
    return [F.col("domain"), F.col("release_year"), X.fold(F.col("title")), F.col("entity_id")]


def edge_keys() -> list[Column]:
    """The order of a family's edges: source, type and target."""
    return [F.col("source_entity_id"), F.col("relationship"), F.col("target_entity_id")]


def neighbours_with_evidence(relationships: DataFrame, evidence: DataFrame) -> DataFrame:
    """Edges with the strength and claim of their evidence; edges without evidence stay, with nulls."""
    signals = evidence.select("evidence_id", F.lit(True).alias("has_evidence"), "evidence_strength", "claim", "source_record_id")
    return relationships.join(signals, "evidence_id", "left").withColumn("has_evidence", F.coalesce("has_evidence", F.lit(False)))


def resolve_title(titles: DataFrame, profiles: DataFrame, queries: DataFrame) -> DataFrame:
    """Entities whose folded title equals a folded query (a stated set), with their profile where there is one."""
    names = titles.select("entity_id", X.fold(F.col("title")).alias("folded"))
    wanted = queries.select("query", X.fold(F.col("query")).alias("folded"))
    return names.join(F.broadcast(wanted), "folded").drop("folded").join(profiles, "entity_id", "left")


def franchise_pairs(ents: DataFrame) -> DataFrame:
    """(entity_id, other_id): entities that share a franchise tag, both ways, each pair once. A franchise of n makes n (n - 1) rows: that is the result.

    A pair that shares several tags is made by the least of them alone, so pairs are never sorted or dealt.
    """
    own = ents.select("entity_id", F.explode("tags").alias("tag")).where(F.col("tag").startswith("franchise:"))
    own = own.groupBy("entity_id").agg(F.array_sort(F.collect_set("tag")).alias("held"))
    m = own.select("entity_id", F.explode("held").alias("tag"), F.when(F.size("held") > 1, F.col("held")).alias("held"))
    other = m.select(F.col("entity_id").alias("other_id"), "tag", F.col("held").alias("_held"))
    first = F.col("held").isNull() | F.col("_held").isNull() | (F.element_at(F.array_intersect("held", "_held"), 1) == F.col("tag"))
    return join_dealt(m, other, "tag").where((F.col("entity_id") != F.col("other_id")) & first).select("entity_id", "other_id")


def exclude_family(df: DataFrame, family: DataFrame) -> DataFrame:
    """Rows whose entity_id is no node of ``family``."""
    return join_dealt(df, family.select(F.col("node").alias("entity_id")), "entity_id", "left_anti")


def two_hops(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(entity_id, other_id, via): entities two undirected edges away from a root and not next to it; ``via`` counts the entities between."""
    both = edges.select("source_entity_id", "target_entity_id").unionByName(edges.select(F.col("target_entity_id").alias("source_entity_id"), F.col("source_entity_id").alias("target_entity_id"))).where("source_entity_id <> target_entity_id").distinct()
    near = both.join(roots.select(F.col("entity_id").alias("source_entity_id")), "source_entity_id", "left_semi").select(F.col("source_entity_id").alias("entity_id"), F.col("target_entity_id").alias("mid"))
    far = near.join(both.select(F.col("source_entity_id").alias("mid"), F.col("target_entity_id").alias("other_id")), "mid").where("entity_id <> other_id")
    far = far.groupBy("entity_id", "other_id").agg(F.count("*").alias("via"))
    return far.join(near.select("entity_id", F.col("mid").alias("other_id")), ["entity_id", "other_id"], "left_anti")


def similarity_candidates(ents: DataFrame, edges: DataFrame, roots: DataFrame, neighbours: DataFrame | None = None, recipe: str = "similarity-candidates-v1") -> DataFrame:
    """Pairs of a root and another entity, with the reasons that speak for them and a score for each reason.

    Reasons: shared_facets (tags, genres, studios or creators in common; the count), graph_distance_2 (two edges apart; the number
    of entities between) and, where ``neighbours`` (entity_id, other_id, score) is given, vector_neighbour. Roots are a stated
    set; scores hold for their own dimension only, so there is no overall score. Pairs come from joins on values and edges.
    """
    facets = None
    for column in ("tags", "genres", "studios", "creators"):
        part = shared_values(ents, column, roots).select("entity_id", "other_id", "overlap")
        facets = part if facets is None else facets.unionByName(part)
    row = lambda df, reason, value: df.select("entity_id", "other_id", F.lit(reason).alias("reason"), value.cast("double").alias("value"))
    found = row(facets.groupBy("entity_id", "other_id").agg(F.sum("overlap").alias("n")), "shared_facets", F.col("n"))
    found = found.unionByName(row(two_hops(edges, roots), "graph_distance_2", F.col("via")))
    if neighbours is not None:
        found = found.unionByName(row(neighbours.join(roots, "entity_id", "left_semi"), "vector_neighbour", F.col("score")))
    found = found.groupBy("entity_id", "other_id").agg(F.array_sort(F.collect_list(F.struct("reason", "value"))).alias("dimensions"))
    reasons = F.transform("dimensions", lambda d: d["reason"])
    strength = F.when(F.size("dimensions") > 1, "medium").otherwise("low")
    ident = X.json_id("similarity", source_entity_id=F.col("entity_id"), target_entity_id=F.col("other_id"), recipe_version=F.lit(recipe))
    return found.select(ident.alias("candidate_id"), F.col("entity_id").alias("source_entity_id"), F.col("other_id").alias("target_entity_id"), F.lit("undirected").alias("candidate_direction"), F.lit(recipe).alias("recipe_version"), reasons.alias("candidate_reasons"), F.map_from_entries("dimensions").alias("score_dimensions"), strength.alias("confidence_tier"))


def fresh_texts(texts: DataFrame, cache: DataFrame, key: str, column: str, provider: str, model: str, recipe: str) -> DataFrame:
    """(key, cache_key, _text) of the rows whose cache key ``cache`` (cache_key) doesn't hold."""
    keyed = texts.select(key, F.col(column).alias("_text")).withColumn("cache_key", X.cache_key("embedding", provider, model, recipe, F.col("_text")))
    return keyed.join(cache.select("cache_key"), "cache_key", "left_anti").select(key, "cache_key", "_text")


def embed(texts: DataFrame, cache: DataFrame, key: str, column: str, provider: str = "deterministic", model: str = "sha256", recipe: str = "embedding-v1", embed_fn: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, cache_key, vector) of the rows whose cache key ``cache`` (cache_key) doesn't hold: unchanged texts are not embedded again.

    ``embed_fn`` makes a vector column of a text column; by default the keyless hash vectors of X19. ``embed_batches`` takes a real model.
    """
    fresh = fresh_texts(texts, cache, key, column, provider, model, recipe)
    return fresh.select(key, "cache_key", (embed_fn or X.hash_embedding)(F.col("_text")).alias("vector"))


#: Models of this worker process by provider, model and recipe.
_MODELS: dict[tuple[str, str, str], Callable[[list[str | None]], list]] = {}


def embed_batches(texts: DataFrame, cache: DataFrame, key: str, column: str, make_model: Callable[[], Callable[[list[str | None]], list]], provider: str, model: str, recipe: str, batch_rows: int = 256) -> DataFrame:
    """(key, cache_key, vector, error) by a real model, called with lists of at most ``batch_rows`` texts.

    ``make_model`` runs once in each worker process and gives a function from texts to as many vectors. Rows whose cache key ``cache`` holds are
    skipped before it. Where a call fails, halves of its texts are tried down to single ones, so one bad text costs itself only: its
    row has a null vector and the error's text. A model that returns another number of vectors, or null for one, fails likewise.
    """
    fresh = fresh_texts(texts, cache, key, column, provider, model, recipe)

    def tried(call: Callable, part: list) -> list[tuple[list[float] | None, str | None]]:
        try:
            found = [[float(x) for x in v] for v in call(part)]
            if len(found) != len(part):
                raise ValueError(f"{len(found)} vectors for {len(part)} texts")
            return [(v, None) for v in found]
        except Exception as e:  # noqa: BLE001  whatever the model raises
            if len(part) == 1:
                return [(None, f"{type(e).__name__}: {e}")]
            half = len(part) // 2
            return tried(call, part[:half]) + tried(call, part[half:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = (provider, model, recipe)
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                if name not in _MODELS:
                    _MODELS[name] = make_model()
                vectors, errors = zip(*tried(_MODELS[name], part.column(2).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(vectors, pa.list_(pa.float64())), pa.array(errors, pa.string())], [key, "cache_key", "vector", "error"])

    return fresh.mapInArrow(run, f"`{key}` {fresh.schema[key].dataType.simpleString()}, cache_key string, vector array<double>, error string")


def retrieval_text(ents: DataFrame) -> DataFrame:
    """Text for retrieval from the allowed fields only."""
    lists = [F.array_join(c, ", ") for c in ("synonyms", "genres", "studios", "creators", "tags")]
    parts = [F.col("title"), F.col("original_title"), F.col("media_type"), F.col("status"), F.nullif(F.col("release_year"), F.lit(0)).cast("string"), *[F.nullif(x, F.lit("")) for x in lists]]
    return ents.select("entity_id", F.concat_ws(" | ", *parts).alias("retrieval_text"))


def _packed(frame: DataFrame, key: str) -> DataFrame:
    """(key, ids, x, names): the vectors of each key as one row of bytes, in the order of their ids, with their names."""

    def gather(k: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id").combine_chunks()
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return pa.table({key: pa.array([k[0].as_py()], pa.int32()), "ids": pa.array([table["vec_id"].to_numpy().tobytes()], pa.binary()), "x": pa.array([x.tobytes()], pa.binary()), "names": pa.array([table["name"].to_pylist()], pa.list_(pa.string()))})

    return frame.select(key, "vec_id", "x", "name").groupBy(key).applyInArrow(gather, f"{key} int, ids binary, x binary, names array<string>")


def nearest_vectors(vectors: DataFrame, k: int = 5, every: int = 20, chunk_bytes: int = 16 << 20, query_bytes: int = 2 << 20, per: str | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector whose id is divisible by ``every`` the ``k`` highest dot products, to
    six places, among all other vectors whatever their label; ties go to the smaller id.

    With ``per``, a column, these are the ``k`` highest among the vectors of each of its values (null is one), which is a column ``name``.
    Vectors take part that are not null, hold finite components only and have the commonest length; an id that repeats stands
    for its smallest array (and the smallest name with it). Each block of ``query_bytes`` of queries meets each chunk of ``chunk_bytes``
    once, and a chunk gives at most ``k`` rows per query (and value), so no list of pairs is made. Queries travel to the chunks.
    """
    name = F.col(per).cast("string") if per else F.lit(None).cast("string")
    good = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("x"), name.alias("name")).where("vec_id is not null and x is not null")
    good = good.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    sizes = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    width = 8 * max(1, sizes.d if sizes else 1)
    good = good.where(F.size("x") == (sizes.d if sizes else 0)).groupBy("vec_id").agg(F.min(F.struct("x", "name")).alias("s")).select("vec_id", "s.x", "s.name")
    n = max(1, good.count())
    chunks, blocks = -(-n * width // chunk_bytes), -(-n * width // (every * query_bytes))
    candidates = _packed(good.withColumn("chunk", F.expr(f"cast(pmod(xxhash64(vec_id), {chunks}) as int)")), "chunk")
    queries = _packed(good.where(F.col("vec_id") % every == 0).withColumn("block", F.expr(f"cast(pmod(xxhash64(vec_id, 7), {blocks}) as int)")), "block")
    sent = queries.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.col("ids").alias("qids"), F.col("x").alias("q"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                cids, qids = (np.frombuffer(r[c], np.int64) for c in ("ids", "qids"))
                c, q = (np.frombuffer(r[name], np.float64).reshape(len(own), -1) for name, own in (("x", cids), ("q", qids)))
                parts: dict[str | None, list[int]] = {}
                for i, name in enumerate(r["names"]):
                    parts.setdefault(name, []).append(i)
                for name, rows in parts.items():
                    own = np.array(rows)
                    for at in range(0, len(qids), 128):
                        score = np.round(q[at : at + 128] @ c[own].T, 6)
                        score[qids[at : at + 128, None] == cids[own]] = -np.inf
                        # Ids ascend within a chunk, so a stable sort leaves ties to the smaller id.
                        best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                        i, j = np.repeat(np.arange(len(score)), best.shape[1]), best.ravel()
                        i, j = i[score[i, j] > -np.inf], j[score[i, j] > -np.inf]
                        yield pa.RecordBatch.from_arrays([pa.array(qids[at + i]), pa.array(cids[own[j]]), pa.array(score[i, j]), pa.array([name] * len(i), pa.string())], ["query_id", "vec_id", "score", "name"])

    found = candidates.join(sent, "chunk").select("ids", "x", "qids", "q", "names").mapInArrow(search, "query_id long, vec_id long, score double, name string")
    ranked = top(found, [F.desc("score"), "vec_id"], k, ["query_id", "name"] if per else ["query_id"])
    return ranked.select("query_id", *(["name"] if per else []), "rank", "vec_id", "score")
