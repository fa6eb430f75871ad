"""What the stages of an edit leave in its documents, as structs of named columns. Documents
are structs of any schema: a field that isn't there is null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .records import display_payload, effective_status, relabel_lifecycle
from .text import first_text


def bound(value: Column, then: Callable[[Column], Column] = lambda x: x) -> Column:
    """then(value), with value computed, and its expression held, once however often then
    reads it; nor does the optimiser put it wherever a field of the result is read."""
    return F.transform(F.array(value), lambda x: then(x))[0]


class Doc:
    """A struct column with its schema. An empty document counts as none."""

    def __init__(self, column: Column | None, schema: StructType | None) -> None:
        self.column, self.schema = (column, schema) if column is not None and isinstance(schema, StructType) else (None, StructType())

    def get(self, name: str, kind: str = "string") -> Column:
        return self.column[name] if name in self.schema.names else F.lit(None).cast(kind)

    def doc(self, name: str) -> Doc:
        return Doc(self.column[name], self.schema[name].dataType) if name in self.schema.names else Doc(None, None)

    def given(self, name: str) -> Column:
        """The field, empty text as null."""
        return F.nullif(self.get(name), F.lit(""))

    def text(self) -> Column:
        """The document as JSON, null where it is empty."""
        return F.lit(None).cast("string") if self.column is None else F.nullif(F.to_json(self.column), F.lit("{}"))

    def there(self) -> Column:
        return self.text().isNotNull()


def _display(original: Column, effective: Column, candidate: Column, status: Column, rewritten: Column, reason: Column, source: Column, display: Column, result: Column, result_reason: Column) -> Column:
    given = {"original": original, "effective": effective, "candidate": candidate, "status": status, "rewritten": rewritten, "reason": reason, "source": source, "display": display, "result": result, "result_reason": result_reason}

    def shown(d: Column) -> Column:
        there = d["result"].isNotNull()
        told = F.coalesce(F.nullif(d["reason"], F.lit("")), F.when(there, d["result_reason"]))
        return bound(display_payload(d["original"], d["effective"], d["candidate"], d["status"], d["rewritten"], told, d["source"], d["display"], there), lambda p: p.withField("stage1_relabel_result", d["result"]))

    return bound(F.struct(*[c.alias(name) for name, c in given.items()]), shown)


def display_from_meta(meta: Doc) -> Column:
    """Of an edit's meta. The detail of the first stage goes before the meta's own fields;
    whether the text was rewritten is only taken from the meta where there is no detail."""
    check = meta.doc("quality_check")
    detail = check.doc("stage_edit_correctness")
    result, own = detail.doc("relabel_result"), meta.doc("stage1_relabel_result")
    of_result = lambda name: F.when(result.there(), result.get(name)).otherwise(own.get(name))
    return _display(
        first_text(detail.get("original_instruction"), meta.get("instruction_text_original"), meta.get("instruction")),
        first_text(detail.get("effective_instruction"), meta.get("instruction_text_effective"), meta.get("instruction_display_text"), meta.get("instruction")),
        first_text(detail.get("candidate_rewrite_instruction"), of_result("instruction"), meta.get("instruction_text_candidate_rewrite")),
        F.coalesce(detail.given("status"), check.given("status"), meta.given("edit_status")),
        F.when(~detail.there(), meta.get("instruction_rewritten_by_stage1", "boolean")),
        first_text(detail.get("relabel_reason"), of_result("reason"), meta.get("instruction_rewrite_reason")),
        F.coalesce(detail.given("instruction_display_source"), meta.given("instruction_display_source")),
        F.coalesce(detail.given("instruction_display_status"), meta.given("instruction_display_status")),
        F.coalesce(result.text(), own.text()),
        of_result("reason"),
    )


def _display_of(doc: Doc, fallback: list[str]) -> Column:
    rest = [doc.given(name) for name in fallback]
    result = doc.doc("stage1_relabel_result")
    return _display(
        F.coalesce(doc.given("instruction_text_original"), *rest),
        F.coalesce(doc.given("instruction_text_effective"), doc.given("instruction_display_text"), *rest),
        doc.get("instruction_text_candidate_rewrite"),
        doc.get("stage1_status"),
        doc.get("instruction_rewritten_by_stage1", "boolean"),
        doc.get("instruction_rewrite_reason"),
        doc.given("instruction_display_source"),
        doc.given("instruction_display_status"),
        result.text(),
        result.get("reason"),
    )


def display_from_item(item: Doc) -> Column:
    """Of an item of an instruction list."""
    return _display_of(item, ["text", "instruction"])


def display_from_text(text: Column) -> Column:
    """Of an item that is a text only."""
    none = F.lit(None).cast("string")
    return _display(text, text, none, none, F.lit(None).cast("boolean"), none, none, F.lit("legacy"), none, none)


def display_from_record(record: Doc) -> Column:
    """Of a stored record."""
    return _display_of(record, ["instruction_text"])


RELABEL_FIELDS = ("relabel_lifecycle_state", "relabel_terminal", "relabel_terminal_outcome", "relabel_attempted", "relabel_last_edit_id", "relabel_terminal_edit_id")


def relabel_fields(doc: Doc, edit: Column, display: Column | None = None) -> Column:
    """P21 under its record names: of a document, or of what is on display (a struct of P16)
    with the document's stored state."""
    status = display["instruction_display_status"] if display is not None else doc.get("instruction_display_status")
    there = display["stage1_relabel_result"].isNotNull() if display is not None else doc.doc("stage1_relabel_result").there()
    given = {"state": doc.get("relabel_lifecycle_state"), "display": status, "there": there, "outcome": doc.get("relabel_terminal_outcome"), "last": doc.get("relabel_last_edit_id"), "end": doc.get("relabel_terminal_edit_id"), "edit": edit}
    life = bound(F.struct(*[c.alias(name) for name, c in given.items()]), lambda d: relabel_lifecycle(*[d[name] for name in given]))
    names = zip(("state", "terminal", "terminal_outcome", "attempted", "last_edit_id", "terminal_edit_id"), RELABEL_FIELDS, strict=True)
    return bound(life, lambda x: F.struct(*[x[short].alias(name) for short, name in names]))


def stage1_fields(meta: Doc) -> Column:
    """All that the first stage left, with what is on display and the relabel state; a
    missing meta leaves nulls and the state of an edit not yet relabelled."""
    check = meta.doc("quality_check")
    detail = check.doc("stage_edit_correctness")
    there, none = meta.there(), F.lit(None).cast("string")
    both = bound(display_from_meta(meta), lambda shown: F.struct(shown.alias("display"), relabel_fields(meta, meta.get("edit_id"), shown).alias("relabel")))
    only = lambda c: F.when(there, c)
    said = F.struct(
        only(effective_status(meta.get("edit_status"))).alias("stage1_status"),
        only(F.coalesce(detail.given("reason"), check.get("reason"))).alias("stage1_reason"),
        only(check.get("error_message")).alias("stage1_error_message"),
        only(check.get("method")).alias("stage1_method"),
        only(detail.get("checked_views", "array<string>")).alias("stage1_checked_views"),
        only(detail.doc("diff_result").text() if detail.doc("diff_result").column is not None else detail.get("diff_result")).alias("stage1_diff_result"),
        only(detail.doc("judge_result").text() if detail.doc("judge_result").column is not None else detail.get("judge_result")).alias("stage1_judge_result"),
        only(check.text()).alias("stage1_raw_response"),
    )
    fresh = relabel_fields(Doc(None, None), none)
    return bound(F.struct(said.alias("said"), F.when(there, both).alias("both")), lambda x: F.struct(*[x["said"][f].alias(f) for f in STAGE1], x["both"]["display"].alias("display"), F.coalesce(x["both"]["relabel"], fresh).alias("relabel")))


STAGE1 = ("stage1_status", "stage1_reason", "stage1_error_message", "stage1_method", "stage1_checked_views", "stage1_diff_result", "stage1_judge_result", "stage1_raw_response")


STAGE2 = {"status": "string", "score": "double", "threshold": "double", "metric": "string", "views": "array<string>", "input_mode": "string", "aggregate": "string", "scores_by_view": "map<string,double>", "provider": "string", "provider_id": "string", "reason": "string"}


def stage2_fields(target: Doc, provider_id: str) -> Column:
    """The check of the provider's own target, else the single one if it names that
    provider or none; its eleven fields and the whole as JSON."""
    own = target.get("target_quality_checks_by_provider", "map<string,struct<status: string>>")
    kinds = target.schema["target_quality_checks_by_provider"].dataType.valueType if target.column is not None and "target_quality_checks_by_provider" in target.schema.names else None
    scoped, single = Doc(own[provider_id] if kinds is not None else None, kinds), target.doc("target_quality_check")
    fits = F.lit(False) if single.column is None else single.column.isNotNull() & F.coalesce(single.get("provider_id") == provider_id, F.lit(True))
    first = F.lit(False) if scoped.column is None else scoped.column.isNotNull()
    of = lambda name, kind: F.when(first, scoped.get(name, kind).cast(kind)).when(fits, single.get(name, kind).cast(kind))
    raw = F.when(first, scoped.text()).when(fits, single.text())
    return F.struct(*[of(name, kind).alias(f"stage2_{name}") for name, kind in STAGE2.items()], raw.alias("stage2_raw_response"))


#: P27. The columns of a new edit record that start without a value, by type.
EMPTY_EDIT = {
    "string": "edit_id edit_scope_id target_model_id target_render_provider_id edit_status target_gen3d_status target_render_status target_gen3d_error_class target_gen3d_error_message stage1_status stage1_reason stage1_method stage1_diff_result stage1_judge_result stage1_raw_response stage2_status stage2_metric stage2_input_mode stage2_aggregate stage2_provider stage2_provider_id stage2_reason stage2_raw_response exclusion_reason final_status last_error_type last_error_message failed_stage api_lane".split(),
    "array<string>": ["stage1_checked_views", "stage2_views"],
    "double": ["stage2_score", "stage2_threshold"],
    "map<string,double>": ["stage2_scores_by_view"],
}


def base_edit_fields(run: dict[str, str], job: Doc, index: Column, kind: Column, type_index: Column, models: dict[str, str]) -> dict[str, Column]:
    """The columns of a new edit record. run names the experiment, its plan, providers and
    mode; job is a prompt record; models names the models and the second stage's settings.
    instruction_text and the fields of what is on display are those of new_display(text)."""
    plan = job.get("instruction_plan", "struct<mode: string, count: int, allowed_types: array<string>>")
    out = {name: F.lit(run[name]) for name in ("experiment_id", "plan_path", "source_provider", "source_provider_id", "target_provider", "target_provider_id", "edit_mode")}
    out |= {name: job.get(name) for name in ("plan_index", "selection_mode", "requested_category_name", "category", "object_name", "prompt_id", "image_id", "source_model_id")}
    out |= {"object_key": F.concat(job.get("category"), F.lit("::"), job.get("object_name")), "instruction_index": index, "instruction_type": kind, "instruction_type_index": type_index}
    out |= {"instruction_plan": plan, "instruction_count_planned": plan["count"]} | {name: F.lit(models.get(name)).cast("string") for name in ("image_generation_model", "edit_model", "checker_model", "stage1_judge_model", "stage2_metric_config")}
    out |= {name: F.lit(None).cast(t) for t, names in EMPTY_EDIT.items() for name in names}
    out |= {"source_gen3d_status": F.lit("passed"), "source_render_status": F.lit("passed"), "entered_stage2": F.lit(False), "is_stage2_eligible": F.lit(False), "attempt_count": F.lit(0)}
    return out | {"retry_meta": F.lit("{}"), "attempt_errors": F.array().cast("array<string>"), "timings": F.lit("{}"), "timing_attempts": F.lit("{}")}


def new_display(text: Column) -> Column:
    """Display and relabel of an instruction that no stage has looked at."""
    none = F.lit(None).cast("string")
    shown = _display(text, text, none, none, F.lit(None).cast("boolean"), none, none, F.lit("pending"), none, none)
    return bound(shown, lambda d: F.struct(d.alias("display"), relabel_fields(Doc(None, None), none, d).alias("relabel")))


DISPLAY_FIELDS = ("instruction_text_original", "instruction_text_candidate_rewrite", "instruction_text_effective", "instruction_rewritten_by_stage1", "instruction_rewrite_reason", "stage1_relabel_result", "instruction_display_text", "instruction_display_source", "instruction_display_status")
