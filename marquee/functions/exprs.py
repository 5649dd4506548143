"""Column expressions of the catalogue: text folding, slugs, ids, URL references, hashes and JSON."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.plans import fixed


def fold(c: Column) -> Column:
    """Lower case, sharp s as ss, white space collapsed, trimmed."""
    return F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("ß"), F.lit("ss")), r"\s+", " "))


def fold_strict(c: Column) -> Column:
    """Exact Unicode case folding, where ``fold`` isn't enough."""

    def strict(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else " ".join(t.casefold().split()))

    return F.pandas_udf(strict, "string")(c)


def slug(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit("_"))


def prefixed_tag(prefix: str, c: Column) -> Column:
    """``prefix:slug``; null for a blank value."""
    return F.when(F.trim(c) != "", F.concat(F.lit(prefix + ":"), slug(c)))


def tag_value(tags: Column, prefix: str) -> Column:
    """The first tag with the prefix, without it."""
    head = prefix + ":"
    return F.substr(F.try_element_at(F.filter(tags, lambda t: t.startswith(head)), F.lit(1)), F.lit(len(head) + 1))


def url_host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def provider_of(url: Column) -> Column:
    """Provider of a known host, otherwise the URL itself."""
    known = F.create_map(*[F.lit(x) for pair in fixed.HOST_PROVIDERS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.coalesce(url_host(url), F.lit(""))), url)


def parse_source_ref(url: Column) -> Column:
    """struct(provider, external_id, url, alias_id) of a supported page, else null. Hosts must match exactly."""
    host, path = url_host(url), F.try_parse_url(url, F.lit("PATH"))
    found = F.lit(None).cast("struct<provider:string,external_id:string,url:string,alias_id:string>")
    for name, (provider, pattern) in reversed(fixed.SOURCE_PATTERNS.items()):
        ref = F.regexp_extract(path, pattern, 1)
        parts = F.struct(F.lit(provider).alias("provider"), ref.alias("external_id"), url.alias("url"), F.concat(F.lit(f"anime:{provider}:"), ref).alias("alias_id"))
        found = F.when((host == name) & (ref != ""), parts).otherwise(found)
    return found


def pick_canonical(refs: Column) -> Column:
    """The reference of the most preferred provider; the last one of a provider counts."""
    order = F.array(*[F.lit(p) for p in fixed.PREFERRED_PROVIDERS])
    ranked = F.transform(refs, lambda r, i: F.struct((-F.when(F.array_position(order, r["provider"]) > 0, F.array_position(order, r["provider"])).otherwise(99)).alias("rank"), i.alias("at"), r.alias("ref")))
    return F.array_max(ranked)["ref"]


def dedupe_keep_order(a: Column) -> Column:
    return F.array_distinct(F.array_compact(a))


def sorted_distinct(a: Column) -> Column:
    return F.array_sort(F.array_distinct(F.array_compact(a)))


def original_title(synonyms: Column) -> Column:
    """The first synonym with a character outside ASCII."""
    return F.try_element_at(F.filter(synonyms, lambda s: s.rlike(r"[^\x00-\x7F]")), F.lit(1))


def year_of(c: Column) -> Column:
    """Year of an ISO date, or else the first four characters as a number; null if neither."""
    return F.coalesce(F.year(F.try_to_date(F.left(c, F.lit(10)), "yyyy-MM-dd")), F.left(c, F.lit(4)).try_cast("int"))


def zero_to_null(year: Column) -> Column:
    return F.nullif(year, F.lit(0))


def stable_id(*parts: Column) -> Column:
    """Raw parts and, last, 16 hex digits of the hash of the last part, joined by colons."""
    return F.concat_ws(":", *parts[:-1], F.left(F.sha2(parts[-1], 256), F.lit(16)))


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys and nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def json_id(prefix: str, **fields: Column) -> Column:
    return F.concat(F.lit(prefix + ":"), F.left(F.sha2(canonical_json(**fields), 256), F.lit(20)))


def cache_key(task: str, provider: str, model: str, recipe: str, normalized: Column) -> Column:
    """``task:`` and the hash of everything a model's answer depends on; ``normalized`` is its input as JSON text."""
    body = canonical_json(input=normalized, model=F.lit(model), provider=F.lit(provider), recipe_version=F.lit(recipe), task=F.lit(task))
    return F.concat(F.lit(task + ":"), F.sha2(body, 256))


def record_hash(*columns: str) -> Column:
    """16 hex digits of the hash of a row's JSON, in the declared order of its columns."""
    return F.left(F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256), F.lit(16))


def content_hash(key: Column, row_json: Column) -> Column:
    """Aggregate: the hash of all rows joined by newlines, in the order of their keys."""
    rows = F.array_sort(F.collect_list(F.struct(key.alias("k"), row_json.alias("j"))))
    return F.sha2(F.array_join(F.transform(rows, lambda r: r["j"]), "\n"), 256)


def is_json_object(text: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def extract_json_object(text: Column) -> Column:
    """The text if it is a JSON object; if it is no JSON at all, what lies from its first to its last brace, if that is one."""
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(is_json_object(text), text).when(F.try_parse_json(text).isNull() & is_json_object(inner), inner)


def merge_lineage(a: Column, b: Column) -> Column:
    """Per field the ordered distinct URLs of both maps."""
    none = F.array().cast("array<string>")
    return F.map_zip_with(a, b, lambda _, x, y: dedupe_keep_order(F.concat(F.coalesce(x, none), F.coalesce(y, none))))


def hash_embedding(text: Column, dimensions: int = 8) -> Column:
    """A deterministic vector: bytes of the text's sha256, scaled to -1..1 and rounded to six places."""
    digest = F.sha2(text, 256)
    byte = lambda i: F.conv(F.substr(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("double")
    return F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: F.round(byte(i) / 255 * 2 - 1, 6))


def snapshot_time(snapshot_id: Column) -> Column:
    """The date after the last colon, else the epoch."""
    return F.coalesce(F.try_to_timestamp(F.substring_index(snapshot_id, ":", -1), F.lit("yyyy-MM-dd")), F.lit("1970-01-01").cast("timestamp"))


def policy_source_id(record_source: Column) -> Column:
    return F.when(record_source.startswith(fixed.RELEASE_PREFIX), F.lit(fixed.RELEASE_SOURCE)).otherwise(record_source)


def main_or_all(studios: Column) -> Column:
    """Names of the main studios, or of all if none is main."""
    main = F.filter(studios, lambda s: s["isMain"])
    return dedupe_keep_order(F.transform(F.when(F.size(main) > 0, main).otherwise(studios), lambda s: s["name"]))


def creator_names(staff: Column) -> Column:
    """Names (full, else native) of staff whose role is on the list of creators."""
    roles = [F.lit(r) for r in fixed.CREATOR_ROLES]
    own = F.filter(staff, lambda s: fold(s["role"]).isin(*roles))
    return dedupe_keep_order(F.transform(own, lambda s: F.coalesce(F.nullif(s["full"], F.lit("")), s["native"])))

