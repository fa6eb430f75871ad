"""Projections, normalisation and validity rules of records, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, first_text

PASSED, FAILED, ERROR = "passed", "failed_quality", "error_quality_check"
VIEWS = ["front", "back", "right", "left", "top", "bottom"]
METRIC_VIEWS = ["front", "back", "left", "right", "top", "bottom"]
OBJECT_STAGES = ["source_prompt_optimization", "source_t2i", "source_gen3d", "source_render", "instruction_generation", "source_pipeline_total", "object_total"]
EDIT_STAGES = ["edit_apply", "mask_artifact_build", "stage1_quality_check", "stage1_total", "target_gen3d", "target_render", "stage2_consistency_check", "edit_pipeline_total"]


def strict(cond: Column, message: str, value: Column) -> Column:
    """value where cond holds; otherwise the query fails with the message."""
    return F.when(F.coalesce(cond, F.lit(False)), value).otherwise(F.raise_error(F.lit(message)))


def optional_text(c: Column) -> Column:
    """Trimmed, blank to null."""
    return F.nullif(clean(c), F.lit(""))


def effective_status(status: Column) -> Column:
    """blank or missing means passed."""
    return F.coalesce(optional_text(status), F.lit(PASSED))


def edit_allowed(status: Column, approved: Column | None = None) -> Column:
    """passed, or approved by hand; only true approves, null doesn't."""
    ok = effective_status(status) == PASSED
    return ok if approved is None else ok | approved.eqNullSafe(F.lit(True))


def final_status(stage1: Column, stage2: Column, rendered: Column, generated: Column) -> Column:
    """P28, with exclusion reasons by exclusion_reason."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    s1, s2 = F.coalesce(stage1, F.lit("")), F.coalesce(stage2, F.lit(""))
    return (
        F.when(s1.isin(FAILED, ERROR), "stage1_failed")
        .when(s1 != PASSED, "in_progress_or_unresolved")
        .when(s2 == PASSED, "stage2_passed")
        .when(s2 == FAILED, "stage2_failed")
        .when(s2 == ERROR, "stage2_error")
        .when(yes(rendered), "in_progress_or_unresolved")
        .when(yes(generated), "target_render_failed")
        .otherwise("target_gen3d_failed")
    )


def exclusion_reason(final: Column) -> Column:
    return F.when(final == "in_progress_or_unresolved", "recovered_partial").when(final != "stage2_passed", final)


def timing_scope(stage: Column) -> Column:
    """P29."""
    return F.when(stage.isin(OBJECT_STAGES), "object").when(stage.isin(EDIT_STAGES), "edit").otherwise("experiment")


def relabel_lifecycle(state: Column, display: Column, has_result: Column, outcome: Column, last_edit: Column, terminal_edit: Column, edit: Column) -> Column:
    """State, terminal, terminal_outcome, attempted, last_edit_id, terminal_edit_id. The
    state is the stored one, else the one the display status tells, else by whether there is
    a result."""
    yes = F.coalesce(has_result, F.lit(False))
    # Display statuses that tell a state.
    told = F.when(clean(display) == "relabel_passed", "passed").when(clean(display) == "relabel_failed", "failed")
    now = F.coalesce(optional_text(state), told, F.when(yes, "in_progress").otherwise("not_started"))
    end = relabel_terminal(now)
    given = lambda c: F.nullif(c, F.lit(""))
    return F.struct(
        now.alias("state"),
        end.alias("terminal"),
        F.when(end, F.when(relabel_terminal(optional_text(outcome)), optional_text(outcome)).otherwise(now)).alias("terminal_outcome"),
        (yes | now.isin("in_progress", "passed", "failed")).alias("attempted"),
        F.coalesce(given(last_edit), edit).alias("last_edit_id"),
        F.when(end, F.coalesce(given(terminal_edit), edit)).alias("terminal_edit_id"),
    )


def relabel_terminal(state: Column) -> Column:
    return state.isin("passed", "failed")


def display_payload(original: Column, effective: Column, candidate: Column, status: Column, rewritten: Column, reason: Column, source: Column, display: Column, has_result: Column) -> Column:
    """One struct; P17 to P19 call it with coalesced paths."""
    orig, cand = clean(original), clean(candidate)
    eff = first_text(effective, original)
    changed = F.coalesce(rewritten, (cand != "") & (cand == eff) & (cand != orig))
    tried = F.coalesce(has_result, F.lit(False)) | (cand != "")
    st = optional_text(status)
    told = (
        F.when(st.isNull(), "legacy")
        .when(changed & (st == PASSED), "relabel_passed")
        .when(st == PASSED, "original_passed")
        .when(tried, "relabel_failed")
        .when(st.isin(FAILED, ERROR), "stage1_failed")
        .otherwise("pending")
    )
    return F.struct(
        orig.alias("instruction_text_original"),
        F.nullif(cand, F.lit("")).alias("instruction_text_candidate_rewrite"),
        eff.alias("instruction_text_effective"),
        changed.alias("instruction_rewritten_by_stage1"),
        optional_text(reason).alias("instruction_rewrite_reason"),
        eff.alias("instruction_display_text"),
        F.coalesce(optional_text(source), F.when(changed, "relabel").otherwise("original")).alias("instruction_display_source"),
        F.coalesce(optional_text(display), told).alias("instruction_display_status"),
    )


def target_id(source: Column, edit: Column) -> Column:
    return F.concat(source, F.lit("_edit_"), edit)


def target_parts(target: Column) -> Column:
    """Split at the last separator; both parts must be there, else null."""
    pattern = "(?s)^(.+)_edit_(.+?)$"
    ok = target.rlike(pattern)
    return F.when(ok, F.struct(F.regexp_extract(target, pattern, 1).alias("source_id"), F.regexp_extract(target, pattern, 2).alias("edit_id")))


def provider_of(path: Column, names: dict[str, str] | None = None) -> Column:
    """The file's stem without model_ wherever it stands, by a map of names where it is in it."""
    stem = F.replace(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", ""), F.lit("model_"), F.lit(""))
    if not names:
        return stem
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(known[stem], stem)


def relative_path(path: Column, project: str, pipeline: str | None = None) -> Column:
    """Relative to the project; below the pipeline's own root pipeline/...; else as it is."""
    out = path
    for root, prefix in ((pipeline, "pipeline/"), (project, "")):
        if root is not None:
            root = root.rstrip("/") + "/"
            out = F.when(path.startswith(root), F.concat(F.lit(prefix), path.substr(len(root) + 1, 1 << 30))).otherwise(out)
    return F.replace(out, F.lit("\\"), F.lit("/"))


def absolute_path(path: Column, project: str, pipeline: str) -> Column:
    """data/pipeline/... lies in the project, pipeline/... in the pipeline's root; other
    paths stay."""
    below = lambda root, p: F.concat(F.lit(root.rstrip("/") + "/"), p)
    return F.when(path.startswith("data/pipeline/"), below(project, path)).when(path.startswith("pipeline/"), below(pipeline, path.substr(len("pipeline/") + 1, 1 << 30))).otherwise(path)


def image_path_parts(path: Column, edited: str, source: str) -> Column:
    """Name, variant_id, is_edited, is_source, by the folders a path goes through and the
    stem <name>_e<variant>."""
    parts = F.split(path, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"(?<=.)\.[^.]*$", "")
    pattern = "^(.+)_e([a-zA-Z0-9]+)$"
    variant = F.array_contains(parts, edited) & stem.rlike(pattern)
    return F.struct(
        F.when(variant, F.regexp_extract(stem, pattern, 1)).otherwise(stem).alias("name"),
        F.when(variant, F.regexp_extract(stem, pattern, 2)).alias("variant_id"),
        F.array_contains(parts, edited).alias("is_edited"),
        (F.array_contains(parts, source) & ~variant).alias("is_source"),
    )


def safe_float(c: Column) -> Column:
    """P42."""
    return c.try_cast("double")


def epoch(c: Column) -> Column:
    """Seconds since 1970 of an ISO time, Z or naive; null if it can't be read."""
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00")).cast("double")


def view_rank(view: Column, order: list[str] = VIEWS, unknown: int = 99) -> Column:
    """W07."""
    known = F.create_map(*[F.lit(x) for i, v in enumerate(order) for x in (v, i)])
    return F.coalesce(known[view], F.lit(unknown))


def known_views(views: Column, allowed: list[str] = VIEWS) -> Column:
    """allowed ones in the order given, each once."""
    allow = F.array(*map(F.lit, allowed))
    return F.array_distinct(F.filter(views, lambda v: F.array_contains(allow, v)))


def views_complete(views: Column, required: list[str] = VIEWS) -> Column:
    """F34."""
    return F.size(F.array_except(F.array(*map(F.lit, required)), views)) == 0


def safe_id(c: Column) -> Column:
    """F23."""
    return F.coalesce((F.length(c) > 0) & (F.length(c) <= 128) & ~c.rlike(r"/|\\|\.\."), F.lit(False))


def is_temporary(name: Column, own: str) -> Column:
    """F30."""
    return name.startswith("_") | (name == own)


def selection_mode(random_category: Column, random_object: Column) -> Column:
    """P40."""
    return F.when(random_category & random_object, "random_category_and_object").when(random_object, "fixed_category_random_object").otherwise("fixed_category_fixed_object")


def allowed_types_ok(types: Column, domain: list[str]) -> Column:
    """Not empty, in the domain, no repeats."""
    allow = F.array(*map(F.lit, domain))
    return F.coalesce((F.size(types) > 0) & F.forall(types, lambda t: F.array_contains(allow, t)) & (F.size(F.array_distinct(types)) == F.size(types)), F.lit(False))


def plan_from_counts(counts: Column, domain: list[str]) -> Column:
    """Total, and the types with a positive count in order; fails on a type outside the
    domain, a negative count, or none at all."""
    total = F.aggregate(F.map_values(counts), F.lit(0), lambda a, x: (a + x).cast("int"))
    ok = F.forall(F.map_keys(counts), lambda k: k.isin(domain)) & F.forall(F.map_values(counts), lambda v: v >= 0) & (total > 0)
    plan = F.struct(F.lit("adaptive_k").alias("mode"), total.alias("count"), F.array_sort(F.map_keys(F.map_filter(counts, lambda k, v: v > 0))).alias("allowed_types"))
    return strict(ok, "instruction counts can't make a plan", plan)


def lane_wait_ratio(waited: Column, total: Column) -> Column:
    """P46."""
    return F.coalesce(F.try_divide(waited, total), F.lit(0.0))


def workers(image: Column, provider: Column, per_provider: Column, render: Column, cap: Column) -> Column:
    """M18."""
    return F.least(image + F.ceil(provider / per_provider) + F.greatest(render, F.lit(2)), cap)


def size_reason(reason: Column) -> Column:
    """The reason up to a bracket, trimmed, lower-cased."""
    return F.lower(F.trim(F.split(reason, r"\(")[0]))


def removal_reasons(score: Column, unfriendly: Column) -> Column:
    """Why an object goes; no score counts as 5."""
    # The reasons, and the score below which an object is too simple.
    simple = F.when(F.coalesce(score, F.lit(5)) < 3, "too_simple")
    return F.array_compact(F.array(simple, F.when(F.coalesce(unfriendly, F.lit(False)), "3d_unfriendly")))
