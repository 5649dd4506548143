"""The data side of model judgments: candidates, prompts, responses, records, the gate, side tables and scores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from marquee.functions import exprs as X
from marquee.functions.skew import join_dealt, join_streamed
from marquee.operators import edges as E
from marquee.operators import prefixes as P
from marquee.plans import fixed

SIDE = ("entity_id", "domain", "title", "original_title", "media_type", "release_year", "genres", "studios", "creators")


def changed_since(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Scored edges with their previous type and score, and whether anything changed."""
    before = previous.select("source_entity_id", "target_entity_id", F.col("relationship").alias("previous_relationship"), F.col("score").alias("previous_score"))
    out = current.join(before, ["source_entity_id", "target_entity_id"], "left")
    same = F.col("relationship").eqNullSafe(F.col("previous_relationship")) & F.col("score").eqNullSafe(F.col("previous_score"))
    return out.withColumn("changed_since_previous", ~same)


def candidates(edges: DataFrame, previous: DataFrame, ents: DataFrame, threshold: float = 0.7, recipe: str = "relationship-judgment-v1") -> DataFrame:
    """Low or generic edges whose two ends are present and public, with fingerprint and cache key."""
    now = changed_since(E.scored(edges), E.with_score(previous)).where((F.col("score") < threshold) | F.col("relationship").isin(fixed.LEGACY_RELATIONSHIPS))
    public = ents.where(F.col("source_role") == fixed.PUBLIC_ROLE)
    end = lambda side: public.select(F.col("entity_id").alias(f"{side}_entity_id"), F.struct(*SIDE).alias(side))
    out = now.join(end("source"), "source_entity_id").join(end("target"), "target_entity_id")
    normalized = X.canonical_json(
        source=F.col("source"), target=F.col("target"), current_relationship=F.col("relationship"), current_confidence_score=F.col("score"), previous_relationship=F.col("previous_relationship"), previous_confidence_score=F.col("previous_score"),
        supporting_source_count=F.col("supporting_source_count"), supporting_provider_count=F.col("supporting_provider_count"), supporting_urls=F.col("supporting_urls"),
    )
    out = out.withColumn("normalized_input", normalized)
    return out.withColumn("input_fingerprint", F.sha2("normalized_input", 256)).withColumn("cache_key", X.cache_key("llm_judgment", "provider", "model", recipe, F.col("normalized_input")))


def candidate_order() -> list:
    return ["score", F.desc("supporting_provider_count"), "source_entity_id", "target_entity_id"]


def prompts(cands: DataFrame, labels: list[str]) -> DataFrame:
    """Prompt text of each candidate, from public fields of public rows only."""
    head = "Decide which label fits the relationship between two works.\nAnswer with one JSON object: relationship (one of " + ", ".join(labels) + "), confidence (0 to 1), reasoning.\nCase:\n"
    return cands.select("cache_key", F.concat(F.lit(head), "normalized_input").alias("prompt"))


def parse_responses(raw: DataFrame, labels: list[str], schema_status: str = "schema_error", label: str = "relationship") -> DataFrame:
    """Adds status (ok, parse_error, the name given for schema errors), the label (relationship), confidence and reasoning of ``raw``."""
    out = raw.withColumn("object", X.extract_json_object(F.col("raw")))
    out = out.withColumn("j", F.from_json("object", f"{label} string, confidence double, reasoning string"))
    extra = F.size(F.array_except(F.json_object_keys("object"), F.array(*[F.lit(k) for k in (label, "confidence", "reasoning")])))
    good = F.col(f"j.{label}").isin(labels) & F.col("j.confidence").between(0, 1) & (F.col("j.reasoning") != "") & (extra == 0)
    out = out.withColumn("status", F.when(F.col("object").isNull(), "parse_error").when(F.coalesce(good, F.lit(False)), "ok").otherwise(schema_status))
    ok = lambda c: F.when(F.col("status") == "ok", F.col(f"j.{c}")).alias(c)
    return out.select(*[c for c in out.columns if c not in ("object", "j")], ok(label), ok("confidence"), ok("reasoning"))


def parse_identity_responses(raw: DataFrame, schema_status: str = "schema_error") -> DataFrame:
    """Adds status, decision (merge, no_merge, uncertain), confidence and reasoning to ``raw``: the schema of identity cases."""
    return parse_responses(raw, ["merge", "no_merge", "uncertain"], schema_status, "decision")


def judgment_records(decisions: DataFrame, edges: DataFrame, ents: DataFrame) -> DataFrame:
    """Whole judgment records of ok decisions whose edge and both entities exist.

    Decisions hold source_entity_id, target_entity_id, cache_key, status, judged, confidence, input_fingerprint, provider, model,
    recipe_version. Inputs are both entities with their role, and are publishable where the role is public; evidence is a row for each
    supporting URL (from 1), publishable where the inputs are and the edge has sources and providers. Null URL lists count as empty.
    Entities are streamed past: only their ids and roles are held, and rows with URLs are not sorted for them.
    """
    support = E.with_support(edges).select("source_entity_id", "target_entity_id", "supporting_urls", "supporting_source_count", "supporting_provider_count")
    role = lambda side: ents.select(F.col("entity_id").alias(f"{side}_entity_id"), F.coalesce("source_role", F.lit("unknown")).alias(f"{side}_role"))
    j = join_dealt(decisions.where("status = 'ok'"), support, ["source_entity_id", "target_entity_id"])
    j = join_streamed(join_streamed(j, role("source"), "source_entity_id"), role("target"), "target_entity_id")
    uses = lambda public: F.when(public, F.array(F.lit("llm_judgment"))).otherwise(F.array().cast("array<string>"))

    def input_ref(side: str):
        public = F.col(f"{side}_role") == fixed.PUBLIC_ROLE
        return F.struct(F.col(f"{side}_entity_id").alias("ref_id"), F.lit("entity").alias("ref_kind"), F.col(f"{side}_role").alias("source_role"), F.lit("publishability-policy-v1").alias("policy_version"), public.alias("publishable"), uses(public).alias("allowed_uses"))

    j = j.withColumn("inputs", F.array(input_ref("source"), input_ref("target"))).withColumn("public", F.forall("inputs", lambda i: i["publishable"]))
    sound = F.col("public") & (F.col("supporting_source_count") > 0) & (F.col("supporting_provider_count") > 0)
    urls = F.coalesce("supporting_urls", F.array().cast("array<string>"))
    evidence = F.transform(urls, lambda u, i: F.struct(F.concat(F.col("cache_key"), F.lit(":supporting_url:"), (i + 1).cast("string")).alias("evidence_id"), F.lit("relationship_supporting_url").alias("evidence_kind"), u.alias("claim"), sound.alias("publishable")))
    flags = F.array_compact(F.array(F.lit("model_inferred"), F.when(F.col("judged") == "uncertain", "unsupported_relationship"), F.when(~F.col("public"), "non_publishable_input")))
    tier = F.when(F.col("confidence") >= 0.9, "high").when(F.col("confidence") >= 0.8, "medium").otherwise("low")
    profile = X.canonical_json(confidence=F.col("confidence"), confidence_tier=tier, evidence_strength=F.lit("model_with_publishable_relationship_evidence"), agreement_status=F.lit("unverified"), extraction_method=F.lit("model_judgment"), freshness_status=F.lit("unknown"), recipe_version=F.col("recipe_version"))
    return j.select(
        F.col("cache_key").alias("judgment_id"), F.concat_ws(":", "source_entity_id", "target_entity_id", "input_fingerprint").alias("candidate_id"), F.lit("relationship_classification").alias("kind"), F.lit("approved").alias("status"),
        "source_entity_id", "target_entity_id", "provider", "model", F.col("recipe_version").alias("prompt_version"), F.create_map(F.lit("temperature"), F.lit("0"), F.lit("max_tokens"), F.lit("300")).alias("parameters"), "inputs", evidence.alias("evidence_refs"),
        F.lit("v1").alias("output_schema_version"), "judged", "confidence", tier.alias("confidence_tier"), flags.alias("quality_flags"), F.size(F.filter(evidence, lambda e: e["publishable"])).alias("publishable_evidence"), profile.alias("confidence_profile_json"),
    )


def side_rows(gated: DataFrame, recipe: Recipe) -> DataFrame:
    """The materialised rows of eligible judgment records; core edges are never rewritten."""
    return gated.where("eligible").select(
        "source_entity_id", "target_entity_id", F.col("judged").alias("relationship_type"), F.col("confidence").alias("relationship_confidence_score"), "judgment_id", F.lit(recipe.recipe_id).alias("materialization_recipe_id"),
        F.lit(recipe.recipe_version).alias("materialization_recipe_version"), "confidence_profile_json", "quality_flags", F.transform("evidence_refs", lambda e: e["evidence_id"]).alias("evidence_ref_ids"),
    )


def apply_to_side_table(gated: DataFrame, recipe: Recipe, path: str) -> DataFrame:
    """Writes the side table to ``path`` (zstd Parquet, replaced on a repeat) and returns one row: judged, eligible, applied and the publishability of what was written."""
    seen = Observation()
    side_rows(gated, recipe).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").parquet(path)
    counts = gated.agg(F.count("*").alias("judged"), F.count_if("eligible").alias("eligible"))
    return counts.select("judged", "eligible", F.lit(int(seen.get["n"])).cast("long").alias("applied"), F.lit("private_experiment_only").alias("publishability_status"))


@dataclass(frozen=True)
class Recipe:
    """What a judgment must satisfy before its row may become queryable."""

    kinds: list[str] = field(default_factory=lambda: ["relationship_classification"])
    output_schema_version: str = "v1"
    min_confidence: float = 0.8
    min_evidence: int = 1
    blocked_flags: list[str] = field(default_factory=lambda: ["low_confidence", "non_publishable_input", "unsupported_relationship"])
    required_use: str = "llm_judgment"
    provider: str | None = None
    model: str | None = None
    prompt_version: str | None = None
    parameters: dict[str, str] = field(default_factory=dict)
    recipe_id: str = "relationship-judgments"
    recipe_version: str = "relationship-materialization-v1"


def gate(judgments: DataFrame, recipe: Recipe) -> DataFrame:
    """Adds reasons (in rule order) and eligible. Parameters are a map column; inputs an array of (publishable, allowed_uses).

    The gate is shut where a value is absent: null in any column that a rule reads, a confidence that is no number, or no input
    at all fail that rule. Null flags count as the flag ``unknown``, which always blocks.
    """
    fixed_value = [(recipe.provider, "provider"), (recipe.model, "model"), (recipe.prompt_version, "prompt_version")]
    fails = lambda rule, reason: F.when(F.coalesce(rule, F.lit(True)), reason)
    rules = [
        fails(F.col("status") != "approved", "judgment_status_not_approved"),
        fails(~F.col("kind").isin(recipe.kinds), "judgment_kind_not_allowed"),
        fails(F.col("output_schema_version") != recipe.output_schema_version, "output_schema_version_mismatch"),
        fails((F.col("confidence") < recipe.min_confidence) | F.isnan("confidence"), "confidence_below_recipe_minimum"),
        *[fails(F.col(c) != v, f"{c}_mismatch") for v, c in fixed_value if v is not None],
        *[fails(F.try_element_at("parameters", F.lit(k)) != v, f"parameter_mismatch:{k}") for k, v in recipe.parameters.items()],
    ]
    flags = F.coalesce("quality_flags", F.array(F.lit("unknown")))
    hit = F.array_sort(F.array_intersect(flags, F.array(*[F.lit(f) for f in [*recipe.blocked_flags, "unknown"]])))
    blocked = F.transform(hit, lambda f: F.concat(F.lit("blocked_quality_flag:"), f))
    inputs = [
        fails((F.size("inputs") < 1) | ~F.forall("inputs", lambda i: F.coalesce(i["publishable"], F.lit(False))), "non_publishable_input_ref"),
        fails((F.size("inputs") < 1) | ~F.forall("inputs", lambda i: F.coalesce(F.array_contains(i["allowed_uses"], recipe.required_use), F.lit(False))), "input_use_not_allowed"),
        fails(F.col("publishable_evidence") < recipe.min_evidence, "insufficient_publishable_evidence_refs"),
    ]
    reasons = F.concat(F.array_compact(F.array(*rules)), blocked, F.array_compact(F.array(*inputs)))
    return judgments.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.agg(F.count("*").alias("executed"), *[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "parse_error", "api_error")])


def run_scores(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(F.count("*").alias("attempts"), *[F.count_if(F.col(c)).alias(c) for c in ("reachable", "valid_json", "correct")], F.min(F.nullif("latency_ms", F.lit(0))).alias("best_latency_ms"))


def rank_models(scores: DataFrame, qualified: DataFrame) -> DataFrame:
    """Rank of qualified models: correct, valid, reachable, then latency; none counts as worst."""
    own = scores.join(F.broadcast(qualified), "model", "left_semi")
    order = [F.desc("correct"), F.desc("valid_json"), F.desc("reachable"), F.coalesce(F.nullif("best_latency_ms", F.lit(0)), F.lit(999_999_999)), "model"]
    return own.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def score_runs(results: DataFrame, cases: DataFrame) -> DataFrame:
    """Results against fixtures of the same case: valid, same entity right, label right."""
    j = results.join(F.broadcast(cases), "case_id")
    return j.select("case_id", "run_id", F.col("label").isNotNull().alias("valid"), F.col("same").eqNullSafe(F.col("expected_same")).alias("same_entity_correct"), F.col("label").eqNullSafe(F.col("expected_label")).alias("label_correct"))


def budget_admission(calls: DataFrame, limit: float, scope: str, order: str, amount: str, rows_per_range: int = 500_000) -> DataFrame:
    """Calls admitted while the running amount of their scope stays within the limit; the first excess stops the scope.

    A negative (or null) amount is rejected: it counts nothing and is never admitted, so the running amount only grows. ``order`` is a
    whole number. Sums run in two steps: over ranges of the order that hold about as many rows each, then inside each.
    """
    spent = F.greatest(F.coalesce(amount, F.lit(0)), F.lit(0))
    out = P.running(calls.withColumn("_spent", spent), scope, order, [order], {"running": ("sum", F.col("_spent"))}, rows_per_range)
    return out.withColumn("admitted", (F.col("running") <= limit) & F.coalesce(F.col(amount) >= 0, F.lit(False))).drop("_spent")
