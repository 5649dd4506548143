"""Publishability policies as small frames: sources by role, fields by rule, artifact columns by use."""

from __future__ import annotations

from itertools import product

# Uses, roles, and which uses a role allows.
PUBLIC_USES = ["PUBLIC_PARQUET", "PUBLIC_MANIFEST", "RETRIEVAL_TEXT", "EMBEDDING_INPUT", "LLM_JUDGMENT_INPUT", "LOCAL_MATCHING", "QA"]
ID_USES = ["PUBLIC_PARQUET", "PUBLIC_MANIFEST", "LOCAL_MATCHING", "QA"]
LOCAL_USES = ["LOCAL_MATCHING", "QA"]
ROLE_USES = {"BACKBONE_SOURCE": PUBLIC_USES, "ID_SOURCE": ID_USES, "LOCAL_EVIDENCE": LOCAL_USES, "RUNTIME_ONLY": LOCAL_USES, "PAID_EXPERIMENT_ONLY": LOCAL_USES, "BLOCKED": []}
ROLE_CLASS = {"BACKBONE_SOURCE": "PUBLIC_METADATA", "ID_SOURCE": "PUBLIC_IDENTIFIER", "LOCAL_EVIDENCE": "LOCAL_ONLY", "RUNTIME_ONLY": "RUNTIME_ONLY", "PAID_EXPERIMENT_ONLY": "PAID_EXPERIMENT_ONLY", "BLOCKED": "BLOCKED"}

# Sources by role.
SOURCES = {
    "bootstrap_seed": "BACKBONE_SOURCE",
    "manami": "BACKBONE_SOURCE",
    "wikidata": "BACKBONE_SOURCE",
    "tvmaze": "BACKBONE_SOURCE",
    "openlibrary": "BACKBONE_SOURCE",
    "tmdb_daily_ids": "ID_SOURCE",
    "anidb_title_dump": "ID_SOURCE",
    "thetvdb": "ID_SOURCE",
    "tmdb_api": "LOCAL_EVIDENCE",
    "anidb_http_api": "LOCAL_EVIDENCE",
    "anilist": "LOCAL_EVIDENCE",
    "mal_api": "LOCAL_EVIDENCE",
    "jikan": "LOCAL_EVIDENCE",
    "kitsu": "LOCAL_EVIDENCE",
    "ann": "LOCAL_EVIDENCE",
    "imdb_datasets": "LOCAL_EVIDENCE",
    "simkl": "LOCAL_EVIDENCE",
    "trakt": "LOCAL_EVIDENCE",
    "omdb": "LOCAL_EVIDENCE",
    "justwatch": "RUNTIME_ONLY",
    "paid_experiment_fixture": "PAID_EXPERIMENT_ONLY",
    "anime_planet": "BLOCKED",
}

# Fields that text may use, more that judgments may use, and identifiers.
TEXT_FIELDS = ["creators", "genres", "media_type", "original_title", "release_year", "status", "studios", "synonyms", "tags", "title"]
JUDGMENT_FIELDS = [*TEXT_FIELDS, "relationship", "relationship_confidence", "relationship_type", "relationship_confidence_score", "supporting_provider_count", "supporting_source_count", "supporting_urls"]
ID_FIELDS = ["entity_id", "source_entity_id", "target_entity_id", "sources", "target_url"]
OTHER_FIELDS = ["domain", "episodes", "canonical_source", "record_source"]
PUBLIC_CLASSES = ["PUBLIC_METADATA", "PUBLIC_IDENTIFIER", "PUBLIC_DERIVED"]


def field_uses(role: str, field: str) -> list[str]:
    """Uses that a field of a source in this role allows."""
    if role != "BACKBONE_SOURCE":
        return ROLE_USES[role] if role != "ID_SOURCE" or field in ID_FIELDS else []
    uses = ["PUBLIC_PARQUET", "PUBLIC_MANIFEST", "LOCAL_MATCHING", "QA"]
    uses += ["RETRIEVAL_TEXT", "EMBEDDING_INPUT"] if field in TEXT_FIELDS else []
    return uses + (["LLM_JUDGMENT_INPUT"] if field in JUDGMENT_FIELDS else [])


def source_rows() -> list[tuple]:
    return [(s, role, ROLE_USES[role]) for s, role in SOURCES.items()]


def field_rows() -> list[tuple]:
    fields = dict.fromkeys([*JUDGMENT_FIELDS, *ID_FIELDS, *OTHER_FIELDS])
    return [(s, f, ROLE_CLASS[role], field_uses(role, f)) for (s, role), f in product(SOURCES.items(), fields) if role != "ID_SOURCE" or f in ID_FIELDS]


def artifact_rows(columns: list[str]) -> list[tuple]:
    """Columns of the public entity artifact, the retrieval text and the judgment prompt."""
    public = [("core", "entities", c, ["PUBLIC_PARQUET"], PUBLIC_CLASSES) for c in columns]
    return [*public, ("retrieval-text", "retrieval_text", "text", ["RETRIEVAL_TEXT", "EMBEDDING_INPUT"], PUBLIC_CLASSES), ("llm-judgment", "llm_judgments", "prompt", ["LLM_JUDGMENT_INPUT"], PUBLIC_CLASSES)]
