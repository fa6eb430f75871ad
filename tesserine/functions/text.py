"""Text rules, error classes and reply parsing, as Column -> Column functions."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists and patterns that results depend on.
LATERAL = [r"\bleft\b", r"\bright\b", r"\bfront\s*[- ]\s*left\b", r"\bfront\s*[- ]\s*right\b", r"\brear\s*[- ]\s*left\b", r"\brear\s*[- ]\s*right\b", r"\bport\b", r"\bstarboard\b", "左", "右"]
AMBIGUOUS_PART = [
    r"\bremove\s+(a|an|one)\s+\w*\s*wheel\b",
    r"\breplace\s+(a|an|one)\s+\w*\s*wheel\b",
    r"\bremove\s+(a|an|one)\s+wheel\b",
    r"\breplace\s+(a|an|one)\s+wheel\b",
    "删除.*一个.*轮",
    "移除.*一个.*轮",
    "删(除|掉).*一个.*轮",
    r"删(除|掉).*轮.*(左|右)?(前|后)?侧?\s*一个",
    r"替换\s*一个.*轮",
    r"更换\s*一个.*轮",
]
TEXTURE = ["color", "colour", "texture", "material", "finish", "pattern", "gloss", "paint", "repaint", "recolor", "recolour", "change the color", "change the colour", "change its color", "change its colour"]
MAIN_BODY = [r"\breplace\s+the\s+entire\b", r"\breplace\s+the\s+whole\b", r"\bremove\s+the\s+entire\b", r"\bwhole\s+object\b", r"\bentire\s+object\b"]
APPEARANCE = ["logo", "emblem", "label", "seam line"]
MATERIALS = ["wood", "wooden", "metal", "metallic", "fabric", "leather", "plastic", "glass"]
REFUSALS = ["i cannot", "i can't", "i am unable", "sorry", "i apologize", "as an ai", "cannot assist", "cannot help", "against my policy", "unable to generate"]
EDIT_TYPES = ["remove", "replace"]


def clean(c: Column) -> Column:
    """Trimmed text; null becomes empty."""
    return F.coalesce(F.trim(c, F.lit(" \t\n\x0b\f\r")), F.lit(""))


def first_text(*cols: Column) -> Column:
    """The first that is not blank, trimmed; empty if all are (P20)."""
    return F.coalesce(*[F.nullif(clean(c), F.lit("")) for c in cols], F.lit(""))


def matches_any(c: Column, patterns: Sequence[str]) -> Column:
    """Any pattern occurs; word edges and classes as for Unicode text."""
    return F.coalesce(F.lower(clean(c)).rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def has_word(c: Column, words: Sequence[str]) -> Column:
    return matches_any(c, [rf"\b\Q{w}\E\b" for w in words])


def has_phrase(c: Column, phrases: Sequence[str]) -> Column:
    low = F.lower(clean(c))
    out = F.lit(False)
    for p in phrases:
        out = out | low.contains(p)
    return out


def is_lateral(c: Column) -> Column:
    return matches_any(c, LATERAL)


def is_ambiguous_part(c: Column) -> Column:
    return matches_any(c, AMBIGUOUS_PART)


def is_texture_edit(c: Column) -> Column:
    return has_word(c, TEXTURE)


def is_main_body_edit(c: Column) -> Column:
    return matches_any(c, MAIN_BODY)


def is_appearance_edit(c: Column) -> Column:
    return has_word(c, APPEARANCE)


def count_terms(c: Column, terms: Sequence[str]) -> Column:
    """How many of the terms occur as whole words."""
    out = F.lit(0)
    for t in terms:
        out = out + has_word(c, [t]).cast("int")
    return out


def is_material_swap(c: Column, terms: Sequence[str] = MATERIALS) -> Column:
    return F.lower(clean(c)).startswith("replace ") & (count_terms(c, terms) >= 2)


def is_refusal(c: Column, phrases: Sequence[str] = REFUSALS) -> Column:
    return has_phrase(c, phrases)


def edit_type(c: Column) -> Column:
    low = F.lower(clean(c))
    return F.when(low.startswith("remove "), "remove").when(low.startswith("replace "), "replace")


def _reasons(c: Column, expected: Column | None) -> list[tuple[Column, str]]:
    kind = edit_type(c)
    rules = [(clean(c) == "", "empty"), (kind.isNull(), "not_remove_or_replace")]
    if expected is not None:
        rules.append((F.coalesce(expected != "", F.lit(False)) & (kind != expected), "edit_type_mismatch"))
    return [*rules, (is_lateral(c), "forbidden_lateral"), (is_ambiguous_part(c), "ambiguous_symmetric_part"), (is_texture_edit(c), "texture_edit"), (is_refusal(c), "refusal")]


def first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """The label of the first rule that holds, else null."""
    return F.coalesce(*[F.when(cond, F.lit(label)) for cond, label in rules])


def text_reject_reason(c: Column, expected: Column | None = None) -> Column:
    """Why a text is no valid instruction, by the first rule it breaks; null if valid."""
    return first_reason(_reasons(c, expected))


def legality_reject_reason(c: Column, expected: Column | None = None) -> Column:
    """text rules, then whole body, appearance and material swap."""
    return first_reason([*_reasons(c, expected), (is_main_body_edit(c), "main_body_edit"), (is_appearance_edit(c), "appearance_edit"), (is_material_swap(c), "material_swap")])


def reply_reject_reason(payload: Column, count: int, allowed: Sequence[str], avoid: Sequence[str] = ()) -> Column:
    """Why a JSON reply (text) is no valid instruction list; null if valid (F16)."""
    keys = lambda c: F.array_sort(F.coalesce(F.json_object_keys(c), F.array().cast("array<string>")))
    parts = F.from_json(payload, "type_judgment string, instructions string")
    judgment = F.from_json(parts["type_judgment"], "allowed_types_used array<string>, preferred_types array<string>, reason_short string")
    items = F.from_json(parts["instructions"], "array<map<string,string>>")
    allow = F.array(*map(F.lit, allowed))
    used = lambda n: judgment[n]
    bad_types = lambda n: used(n).isNull() | F.exists(used(n), lambda x: F.coalesce(~F.array_contains(allow, F.trim(x)), F.lit(True))) | (F.size(F.array_distinct(F.transform(used(n), F.trim))) != F.size(used(n)))
    text = lambda x: F.trim(x["instruction"])
    kind = lambda x: F.trim(x["type"])
    low = F.transform(items, lambda x: F.struct(kind(x).alias("t"), F.lower(text(x)).alias("i")))
    avoided = F.array(*[F.lit(a.strip().lower()) for a in avoid if a.strip()]).cast("array<string>")
    return first_reason(
        [
            (F.coalesce(keys(payload) != F.array(F.lit("instructions"), F.lit("type_judgment")), F.lit(True)), "top_level_keys"),
            (F.coalesce(keys(parts["type_judgment"]) != F.array(F.lit("allowed_types_used"), F.lit("preferred_types"), F.lit("reason_short")), F.lit(True)), "judgment_keys"),
            (clean(used("reason_short")) == "", "reason_blank"),
            (bad_types("allowed_types_used") | bad_types("preferred_types"), "judgment_types"),
            (F.coalesce(F.size(items) != count, F.lit(True)), "instruction_count"),
            (F.exists(items, lambda x: F.coalesce(F.array_sort(F.map_keys(x)) != F.array(F.lit("instruction"), F.lit("type")), F.lit(True))), "item_keys"),
            (F.exists(items, lambda x: F.coalesce(~F.array_contains(allow, kind(x)), F.lit(True))), "item_type"),
            (F.exists(items, lambda x: legality_reject_reason(x["instruction"], kind(x)).isNotNull()), "item_illegal"),
            (F.exists(low, lambda x: F.array_contains(avoided, x["i"])), "avoided"),
            (F.size(F.array_distinct(low)) != F.size(low), "duplicate"),
        ]
    )


def target_error_class(message: Column) -> Column:
    """F32."""
    m = clean(message)
    low = F.lower(m)
    return (
        F.when(m == "", "unknown")
        .when(low.contains("requestlimitexceeded.jobnumexceed") | m.contains("配额超限"), "quota_limit")
        .when(m.contains("主体占比值低于阈值"), "subject_too_small")
        .when(low.contains("upload") | m.contains("上传"), "upload_error")
        .when(low.contains("generation failed:") | low.contains("status=failed"), "provider_failed")
        .otherwise("unknown")
    )


# Phrases of messages and the class each gives, in order of precedence.
MESSAGE_CLASSES = [
    ("not valid json", "response_not_json"),
    ("must contain exactly", "response_schema_invalid"),
    ("missing required field", "response_schema_invalid"),
    ("forbidden lateral terms", "response_rule_forbidden_lateral"),
    ("ambiguous symmetric-part edit", "response_rule_ambiguous_symmetric_part"),
    ("texture/color/material edit", "response_rule_texture_material_edit"),
    ("whole-object/main-body edit", "response_rule_main_body_edit"),
    ("appearance-only/surface-only edit", "response_rule_surface_edit"),
    ("material-swap edit", "response_rule_material_swap"),
    ("refusal response", "response_rule_refusal"),
    ("duplicate instruction", "response_rule_duplicate_instruction"),
    ("repeats an avoided instruction", "response_rule_avoid_list_repeat"),
    ("timeout", "api_timeout"),
    ("request failed", "api_request_exception"),
]


def stage_error_class(message: Column, error_type: Column, status_code: Column, stage1_status: Column) -> Column:
    """bands of the status code, then the quality check's own errors, then phrases."""
    low = F.lower(F.coalesce(message, F.lit("")))
    status = F.coalesce(F.trim(stage1_status), F.lit(""))
    checker = F.when(low.rlike("server error 5[0-9][0-9]"), "api_server_error").when(low.contains("timeout"), "api_timeout").when(low.contains("request failed"), "api_request_exception").when(low.contains("not valid json"), "response_not_json").otherwise("quality_check_execution_error")
    out = F.when(status_code >= 500, "api_server_error").when(status_code >= 400, "api_http_error")
    out = out.when(status == "error_quality_check", checker).when(status == "failed_quality", F.lit("quality_check_failed"))
    for phrase, label in MESSAGE_CLASSES:
        out = out.when(low.contains(phrase), F.lit(label))
    return out.when(error_type == "StageValidationFailed", "quality_check_failed").otherwise("unknown")


# ---- replies ------------------------------------------------------------------------------


def unfenced(c: Column) -> Column:
    """What a code fence holds, or the text; a leading "json" goes too."""
    c = F.trim(c)
    inner = F.regexp_extract(c, r"(?s)^```[A-Za-z]*\s*(.*?)\s*```", 1)
    body = F.when(c.startswith("```") & (inner != ""), inner).otherwise(c)
    return F.trim(F.regexp_replace(body, r"^json\s*(?=[\{\[])", ""))


def greedy_object(c: Column) -> Column:
    """The text if it is an object, else from the first brace to the last; null if
    that isn't JSON."""
    inner = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    valid = lambda x: F.when(F.json_object_keys(x).isNotNull(), x)
    return F.coalesce(valid(F.trim(c)), valid(inner))


def first_object(c: Column) -> Column:
    """The first balanced object, aware of quotes; null if there is none. One pass over
    the characters that matter: braces, quotes and escapes."""
    from collections.abc import Iterator

    import pandas as pd

    def scan(text: str | None) -> str | None:
        start = (text or "").find("{")
        if start < 0:
            return None
        depth, quoted, skip = 0, False, False
        for i, ch in enumerate(text[start:], start):
            if skip:
                skip = False
            elif quoted:
                skip, quoted = ch == "\\", ch != '"'
            elif ch == '"':
                quoted = True
            elif ch in "{}":
                depth += 1 if ch == "{" else -1
                if not depth:
                    return text[start : i + 1]
        return None

    def run(batches: "Iterator[pd.Series]") -> "Iterator[pd.Series]":
        for s in batches:
            yield s.map(scan)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(c)


def reply_array(c: Column, schema: str) -> Column:
    """A fenced JSON array of objects."""
    return F.from_json(unfenced(c), f"array<struct<{schema}>>")


def answer_tag(c: Column) -> Column:
    """The text between answer tags, lower-cased; null without tags."""
    return F.when(c.rlike("(?is)<answer>.*?</answer>"), F.lower(F.trim(F.regexp_extract(c, "(?is)<answer>(.*?)</answer>", 1))))


def compose(*parts: Column, sep: str = " ") -> Column:
    """Non-blank parts in order."""
    return F.concat_ws(sep, *[F.nullif(clean(p), F.lit("")) for p in parts])


# Keys whose values are never logged, and what stands for them.
SECRET_KEYS = ["authorization", "x-api-key", "api_key", "apikey", "bearer"]
MASK = "***REDACTED***"


def redacted_json(c: Column) -> Column:
    """JSON with any value of a secret key masked, at any depth; null where it can't be
    parsed. Depth is open, so small Python code walks the values, in Arrow batches."""
    keys = set(SECRET_KEYS)

    def masked(v):
        if isinstance(v, dict):
            return {k: MASK if k.lower() in keys else masked(x) for k, x in v.items()}
        return [masked(x) for x in v] if isinstance(v, list) else v

    def one(s):
        try:
            return json.dumps(masked(json.loads(s)), ensure_ascii=False, separators=(",", ":"))
        except (TypeError, ValueError):
            return None

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return run(c)


def log_field(line: Column, key: str) -> Column:
    """The value of key= in a log line; values may hold spaces."""
    return F.regexp_extract(line, key + r"=([^ ]+(?:\s[^ ]+)*?)(?=\s+\w+=|\s*$)", 1)


def slug(c: Column, default: str) -> Column:
    """P44."""
    return F.coalesce(F.nullif(F.lower(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")), F.lit("")), F.lit(default))
