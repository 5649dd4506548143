"""Fixed values that results depend on: hosts, patterns, vocabularies, weights and rule tables."""

from __future__ import annotations

# Provider of each known host.
HOST_PROVIDERS = {
    "anidb.net": "anidb",
    "anilist.co": "anilist",
    "myanimelist.net": "myanimelist",
    "kitsu.app": "kitsu",
    "simkl.com": "simkl",
    "anime-planet.com": "anime-planet",
}

# Path pattern of each supported host, the external id as its first group.
NUMBER, NUMBER_AND_MORE, NAME = r"^/anime/(\d+)$", r"^/anime/(\d+)(?:/.*)?$", r"^/anime/([^/]+)$"
SOURCE_PATTERNS = {
    "anidb.net": ("anidb", NUMBER),
    "anilist.co": ("anilist", NUMBER),
    "myanimelist.net": ("myanimelist", NUMBER_AND_MORE),
    "kitsu.app": ("kitsu", NAME),
    "simkl.com": ("simkl", NUMBER_AND_MORE),
    "anime-planet.com": ("anime-planet", NAME),
}
PREFERRED_PROVIDERS = ["anidb", "anilist", "myanimelist", "kitsu", "simkl", "anime-planet"]

# Names of sources, roles and recipes in the written tables.
RELEASE_PREFIX, RELEASE_SOURCE = "manami-project/anime-offline-database", "manami"
PUBLIC_ROLE = "BACKBONE_SOURCE"
SOURCE_ROLES = ["BACKBONE_SOURCE", "ID_SOURCE", "LOCAL_EVIDENCE", "RUNTIME_ONLY", "PAID_EXPERIMENT_ONLY", "BLOCKED"]
TABLE_RECIPE, EDGE_RECIPE, POLICY_VERSION = "core-v1", "relationship-taxonomy-v1", "source-policy-v1"
CREATOR_ROLES = ["creator", "original creator", "original story", "original work"]
MEDIA_TYPES = ["TV", "MOVIE", "OVA", "ONA", "SPECIAL", "UNKNOWN"]
STATUSES = ["FINISHED", "ONGOING", "UPCOMING", "UNKNOWN"]
SECRET_MARKERS = ["token=", "bearer ", "secret=", "api_key="]

# Relationship, family, direction, inverse, deterministic.
TAXONOMY = [
    ("same_entity", "identity", "undirected", "same_entity", True),
    ("sequel", "continuity", "directed", "prequel", True),
    ("prequel", "continuity", "directed", "sequel", True),
    ("continuation", "continuity", "directed", None, True),
    ("spinoff", "franchise", "directed", None, True),
    ("side_story", "episode_context", "directed", None, True),
    ("special", "episode_context", "directed", None, True),
    ("recap", "episode_context", "directed", None, True),
    ("compilation", "episode_context", "directed", None, True),
    ("movie_tie_in", "episode_context", "directed", None, True),
    ("remake", "variant", "directed", None, True),
    ("reboot", "variant", "directed", None, True),
    ("retelling", "variant", "directed", None, True),
    ("alternate_adaptation", "adaptation", "undirected", "alternate_adaptation", True),
    ("adaptation_of", "adaptation", "directed", "adapted_by", True),
    ("adapted_by", "adaptation", "directed", "adaptation_of", True),
    ("source_material", "adaptation", "directed", "adapted_by", True),
    ("same_franchise", "franchise", "undirected", "same_franchise", True),
    ("shared_universe", "franchise", "undirected", "shared_universe", True),
    ("similar_to", "similarity", "undirected", "similar_to", False),
    ("unrelated", "uncertain", "undirected", "unrelated", False),
    ("uncertain", "uncertain", "unknown", None, False),
    ("sequel_prequel", "continuity", "paired", "sequel_prequel", False),
    ("movie_related", "episode_context", "unknown", None, False),
    ("special_related", "episode_context", "unknown", None, False),
    ("remake_reboot", "variant", "unknown", None, False),
    ("adaptation_related", "adaptation", "unknown", None, False),
    ("franchise_related", "franchise", "unknown", None, False),
    ("related_anime", "uncertain", "unknown", None, False),
    ("same_creator", "similarity", "undirected", "same_creator", False),
    ("same_studio", "similarity", "undirected", "same_studio", False),
]

# Base confidence of a relationship; others have OTHER_BASE.
BASE_CONFIDENCE = {
    "adaptation_related": 0.62,
    "adaptation_of": 0.74,
    "adapted_by": 0.74,
    "alternate_adaptation": 0.7,
    "compilation": 0.7,
    "continuation": 0.78,
    "franchise_related": 0.55,
    "movie_related": 0.72,
    "movie_tie_in": 0.72,
    "prequel": 0.78,
    "recap": 0.7,
    "reboot": 0.76,
    "remake": 0.76,
    "same_creator": 0.68,
    "same_franchise": 0.62,
    "same_studio": 0.66,
    "sequel": 0.78,
    "special_related": 0.7,
    "special": 0.7,
    "sequel_prequel": 0.78,
    "remake_reboot": 0.76,
    "related_anime": 0.42,
}
OTHER_BASE = 0.4
LEGACY_RELATIONSHIPS = ["adaptation_related", "franchise_related", "movie_related", "related_anime", "remake_reboot", "sequel_prequel", "special_related"]

# Relation types of the provider feed, and formats for PARENT and CONTAINS.
RELATION_RULES = {"SEQUEL": "sequel", "PREQUEL": "prequel", "SPIN_OFF": "spinoff", "SIDE_STORY": "side_story", "SUMMARY": "recap", "COMPILATION": "compilation"}
FORMAT_RULES = {"MOVIE": "movie_tie_in", "SPECIAL": "special", "OVA": "special", "ONA": "special", "TV_SHORT": "special"}

# Concept words and what they stand for.
GENRE_WORDS = {"action": "Action", "adventure": "Adventure", "comedy": "Comedy", "drama": "Drama", "fantasy": "Fantasy", "romance": "Romance", "slice of life": "Slice of Life"}
TAG_RULES = [(["college", "university"], ["College", "Primarily Adult Cast"]), (["adult", "adults"], ["Primarily Adult Cast"])]
CONCEPT_NOTES = [
    (["university", "college"], "mapped university/college language to AniList College + Primarily Adult Cast tags"),
    (["romance"], "mapped romance language to AniList Romance genre"),
]
