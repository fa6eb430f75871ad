"""Category, funnel, timing and distribution statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import ERROR, FAILED, PASSED, optional_text, safe_float, timing_scope
from ..functions.stages import Doc
from ..functions.text import clean


def _count(cond: Column, name: str) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False))).alias(name)


def edit_aggregates(prefix: str = "") -> list[Column]:
    """Funnel counts and score statistics over edit records."""
    s1, s2, score = F.col(prefix + "stage1_status"), F.col(prefix + "stage2_status"), F.col(prefix + "stage2_score")
    return [
        F.count("*").alias("edit_attempts_total"),
        _count(s1.isin(FAILED, ERROR), "stage1_failed_count"),
        _count(F.col(prefix + "entered_stage2"), "stage2_entered_count"),
        _count(s2 == PASSED, "stage2_passed_count"),
        _count(s2 == FAILED, "stage2_failed_count"),
        F.avg(score).alias("score_mean"),
        F.stddev_pop(score).alias("score_std"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
    ]


_COUNTS = ["edit_attempts_total", "stage1_failed_count", "stage2_entered_count", "stage2_passed_count", "stage2_failed_count"]


def _with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{n}_rate": F.try_divide(F.col(f"{n}_count"), F.col("edit_attempts_total")) for n in ("stage1_failed", "stage2_entered")})


def _object_stats(objects: DataFrame) -> DataFrame:
    return objects.filter(clean(F.col("category")) != "").groupBy("category").agg(
        F.array_sort(F.collect_set(F.when(F.col("object_name") != "", F.col("object_name")))).alias("distinct_objects"), F.count("*").alias("sample_count")
    )


def category_stats(objects: DataFrame, edits: DataFrame) -> DataFrame:
    """Categories of either side; ordered by samples, then name."""
    by_edit = edits.filter(clean(F.col("category")) != "").groupBy("category").agg(*edit_aggregates())
    out = _object_stats(objects).join(by_edit, "category", "full_outer")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("sample_count", *_COUNTS)}).withColumn("distinct_objects", F.coalesce("distinct_objects", F.array().cast("array<string>")))
    return _with_rates(out.drop("score_min", "score_max")).orderBy(F.desc("sample_count"), "category")


def category_stats_of_objects(objects: DataFrame, edits: DataFrame, kinds: Sequence[str] = ("remove", "replace")) -> DataFrame:
    """Categories of objects only; minima, maxima and figures for each kind of edit."""
    kind = F.col("instruction_type")
    failed = F.col("stage1_status").isin(FAILED, ERROR)
    extra = []
    for k in kinds:
        mine = kind == k
        extra += [_count(mine, f"{k}_attempts_total"), F.avg(F.when(mine, F.coalesce(failed, F.lit(False)).cast("double"))).alias(f"{k}_stage1_failed_rate"), F.avg(F.when(mine, F.col("stage2_score"))).alias(f"{k}_score_mean")]
    by_edit = edits.groupBy("category").agg(*edit_aggregates(), *extra)
    out = _object_stats(objects).join(by_edit, "category", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in (*_COUNTS, *[f"{k}_attempts_total" for k in kinds])})
    return _with_rates(out).withColumn("stage2_failed_rate", F.try_divide("stage2_failed_count", "stage2_entered_count")).orderBy("category")


def run_totals(edits: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """One row of funnel counts, with the number of objects if given."""
    totals = edits.agg(*edit_aggregates()[:5])
    return totals if objects is None else objects.agg(F.count("*").alias("object_count")).join(totals, F.lit(True))


def planned_totals(plan: DataFrame, objects: str = "object_count", edits: str = "edit_count") -> DataFrame:
    """A28."""
    return plan.agg(F.sum(F.col(objects) * F.col(edits)).alias("planned_total"))


def flatten_timings(records: DataFrame, field: str, keep: Sequence[str] = ()) -> DataFrame:
    """Map of entry, or map of lists of entries, to one row an entry."""
    values = F.map_values(F.col(field))
    if dict(records.dtypes)[field].startswith("map<string,array"):
        values = F.flatten(values)
    return records.select(*keep, F.explode(values).alias("_e")).select(*keep, "_e.*")


def timing_summary(entries: DataFrame, basis: str, derive_scope: bool = False) -> DataFrame:
    """A04; with derive_scope A06, where a blank scope follows the stage."""
    blank = timing_scope(F.col("stage_name")) if derive_scope else F.lit("unknown")
    scope = F.coalesce(optional_text(F.col("scope")), blank)
    t = F.col("elapsed_seconds")
    return (
        entries.withColumn("scope", scope)
        .groupBy("scope", "stage_name")
        .agg(
            F.count("*").alias("count"),
            _count(F.col("status") == "success", "success_count"),
            _count(F.col("status") == "skipped", "skipped_count"),
            _count(F.col("status") == "failed", "failed_count"),
            F.sum(t).alias("total_seconds"),
            F.avg(t).alias("mean_seconds"),
            F.median(t).alias("median_seconds"),
            F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY elapsed_seconds)").alias("p90_seconds"),
            F.min(t).alias("min_seconds"),
            F.max(t).alias("max_seconds"),
        )
        .withColumn("aggregation_basis", F.lit(basis))
        .orderBy("scope", "stage_name")
    )


def timing_bundle(objects: DataFrame, edits: DataFrame) -> DataFrame:
    """Attempts, and final entries, of both sides."""
    out = None
    for field, basis in (("timing_attempts", "attempt"), ("timings", "final_record")):
        part = timing_summary(flatten_timings(objects, field).unionByName(flatten_timings(edits, field)), basis)
        out = part if out is None else out.unionByName(part)
    return out


def status_histogram(df: DataFrame, keys: Sequence[str], status: str) -> DataFrame:
    """Counts of each status as a map; counted first, so that lists stay short."""
    n = df.groupBy(*keys, status).agg(F.count("*").alias("n"))
    return n.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(status), F.col("n"))))).alias("status_counts"))


def object_rollup(edits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts, ids in order, score figures and histogram of an object's edits."""
    ids = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(F.col("instruction_index"), F.col(c).alias("v")))), lambda s: s["v"])
    main = edits.groupBy(*keys).agg(*edit_aggregates(), F.filter(ids("edit_id"), lambda x: x.isNotNull()).alias("edit_ids"), F.filter(ids("target_model_id"), lambda x: x.isNotNull()).alias("target_model_ids"))
    return main.join(status_histogram(edits, keys, "final_status"), list(keys))


def distribution(df: DataFrame, value: str, keys: Sequence[str] = (), points: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Count, mean and linear percentiles of the finite values."""
    v = safe_float(F.col(value))
    finite = df.withColumn("_v", v).filter("_v is not null and not isnan(_v) and abs(_v) < double('infinity')")
    names = [f"p{round(p * 100):02d}" for p in points]
    out = finite.groupBy(*keys).agg(F.count("*").alias("count"), F.avg("_v").alias("mean"), F.percentile("_v", F.array(*map(F.lit, points))).alias("_p"))
    return out.select(*keys, "count", "mean", *[F.coalesce(F.col("_p")[i], F.lit(float("nan"))).alias(n) for i, n in enumerate(names)])


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A19."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).orderBy(F.desc("count"), *keys)


def missing_counts(df: DataFrame, views: str, required: Sequence[str]) -> DataFrame:
    """How many items lack each required key of a map; total first."""
    lacking = [F.count_if(F.col(views)[v].isNull()).alias(v) for v in required]
    row = df.agg(*lacking)
    names = ", ".join(f"'{v}', `{v}`" for v in required)
    return row.selectExpr(f"stack({len(required)}, {names}) as (view, missing)")


def size_report(df: DataFrame, before: str, after: str, kinds: Sequence[str], limits: Sequence[float]) -> DataFrame:
    """Mean ratio, mean absolute change in percent, and how many stay within each limit,
    by group."""
    change = F.abs(F.col(after) - F.col(before)) / F.col(before) * 100
    within = [F.count_if(F.col("_c") <= x).alias(f"within_{x:g}") for x in limits]
    return df.withColumn("_r", F.col(after) / F.col(before)).withColumn("_c", change).groupBy(*kinds).agg(F.count("*").alias("count"), F.avg("_r").alias("mean_ratio"), F.avg("_c").alias("mean_change_pct"), *within)


def run_summary(manifests: DataFrame, edits: DataFrame) -> DataFrame:
    """A10: a run's stored totals before recounted ones, with score figures."""
    counted = edits.groupBy("experiment_id").agg(*edit_aggregates())
    names = ["edit_attempts_total", "stage1_failed_count", "stage2_entered_count", "stage2_passed_count", "stage2_failed_count"]
    stored = manifests.select("experiment_id", *[F.col(f"totals.{n}").alias(f"_{n}") for n in names])
    return stored.join(counted, "experiment_id", "left").select("experiment_id", *[F.coalesce(f"_{n}", n, F.lit(0)).alias(n) for n in names], "score_mean", "score_std")


def run_state(manifests: DataFrame, objects: DataFrame, edits: DataFrame) -> DataFrame:
    """Planned and recorded counts, failures by kind, and the state they tell. Stored totals
    stand before counts."""
    s1, s2 = F.col("stage1_status"), F.col("stage2_status")
    by_edit = edits.groupBy("experiment_id").agg(F.count("*").alias("_edits"), _count(s1.isin(FAILED, ERROR), "_s1"), _count(s2 == FAILED, "_s2"), _count(s2 == ERROR, "stage2_error_count"))
    by_object = objects.groupBy("experiment_id").agg(F.count("*").alias("_objects"), _count(F.col("source_pipeline_status") == "failed", "source_pipeline_failed_count"))
    out = manifests.join(by_edit, "experiment_id", "left").join(by_object, "experiment_id", "left")
    zero = lambda *c: F.coalesce(*c, F.lit(0))
    raw = optional_text(F.col("status"))
    progress = Doc(F.col("progress"), manifests.schema["progress"].dataType)
    out = out.select(
        "experiment_id",
        *[progress.get(c, "long").alias(c) for c in ("planned_object_count", "planned_edit_count")],
        raw.alias("raw_status"),
        zero("progress.object_record_count", "_objects").alias("object_record_count"),
        zero("progress.edit_record_count", "_edits").alias("edit_record_count"),
        zero("source_pipeline_failed_count").alias("source_pipeline_failed_count"),
        zero("totals.stage1_failed_count", "_s1").alias("stage1_failed_count"),
        zero("totals.stage2_failed_count", "_s2").alias("stage2_failed_count"),
        zero("stage2_error_count").alias("stage2_error_count"),
        F.coalesce("partial_recovered", F.lit(False)).alias("repair_recommended"),
        (F.coalesce(F.col("finished_at") != "", F.lit(False)) | F.coalesce(raw == "completed", F.lit(False))).alias("_done"),
    )
    failed = F.greatest("source_pipeline_failed_count", "stage1_failed_count", "stage2_failed_count", "stage2_error_count") > 0
    state = (
        F.when(F.col("repair_recommended"), "repair_needed")
        .when(F.col("_done") & failed, "completed_with_failures")
        .when(F.col("_done"), "completed")
        .when(F.col("raw_status").isin("running", "interrupted"), "interrupted")
        .otherwise(F.coalesce("raw_status", F.lit("interrupted")))
    )
    return out.withColumn("status", state).withColumn("resumable", F.col("status").isin("interrupted", "repair_needed")).drop("_done")


def plan_summary(manifests: DataFrame, *by: str) -> DataFrame:
    """Runs and the time of the latest, by plan (and what else is given); a run's time
    is when it finished, else when it started."""
    t = F.coalesce(F.nullif("finished_at", F.lit("")), F.col("started_at"), F.lit(""))
    return manifests.groupBy("plan_path", *by).agg(F.count("*").alias("run_count"), F.max(t).alias("latest"), F.max_by("name", F.struct(t, F.col("name"))).alias("name")).orderBy(F.desc("latest"), "plan_path")


def plan_details(manifests: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """plan_path, yaml_name, plan_name, source_provider, target_provider, edit_mode,
    category_count, experiment_run_count, latest_run_time, plan_file_exists, plan_categories: a
    row a plan, told by its newest run; files: path of the plan files there are."""
    t = F.coalesce(F.nullif("finished_at", F.lit("")), F.col("started_at"), F.lit(""))
    doc = Doc(F.struct(*manifests.columns), manifests.schema)
    plan = doc.doc("plan")
    held = plan.get("categories", "array<struct<category_name: string>>")
    newest = F.max_by(F.struct(doc.get("name").alias("plan_name"), *[doc.get(c).alias(c) for c in ("source_provider", "target_provider", "edit_mode")], held.alias("plan_categories")), F.struct(t, doc.get("started_at"), doc.get("experiment_id")))
    out = manifests.groupBy("plan_path").agg(F.count("*").alias("experiment_run_count"), F.nullif(F.max(t), F.lit("")).alias("latest_run_time"), newest.alias("n"))
    there = F.lit(None).cast("boolean")
    if files is not None:
        out = out.join(files.select(F.col("path").alias("plan_path"), F.lit(True).alias("_there")).distinct(), "plan_path", "left")
        there = F.coalesce("_there", F.lit(False))
    name = F.regexp_extract("plan_path", "([^/]*)$", 1).alias("yaml_name")
    count = F.greatest(F.coalesce(F.size("n.plan_categories"), F.lit(0)), F.lit(0)).alias("category_count")
    return out.select("plan_path", name, "n.plan_name", "n.source_provider", "n.target_provider", "n.edit_mode", count, "experiment_run_count", "latest_run_time", there.alias("plan_file_exists"), "n.plan_categories").orderBy(F.desc("latest_run_time"), "plan_path")


def plan_categories(manifests: DataFrame) -> DataFrame:
    """The categories of a plan, numbered from 1; those of its first run count."""
    first = manifests.groupBy("plan_path").agg(F.min_by("categories", "experiment_id").alias("categories"))
    return first.select("plan_path", F.posexplode("categories").alias("index", "category")).select("plan_path", (F.col("index") + 1).alias("index"), "category.*")


def provider_pairs(manifests: DataFrame) -> DataFrame:
    """A15."""
    return manifests.select("source_provider", "target_provider").distinct().orderBy("source_provider", "target_provider")


def pair_counters(models: DataFrame, target_only: bool = False) -> DataFrame:
    """Models with edits, or with ready pairs only, and the sums of both counts."""
    n, ready = (F.coalesce(F.col(c).cast("long"), F.lit(0)) for c in ("edit_count", "ready_pair_count"))
    shown = models.filter((ready if target_only else n) > 0)
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return shown.agg(F.count("*").alias("total"), zero(ready if target_only else n).alias("total_edits"), zero(ready).alias("total_with_target_3d"))


def review_counts(df: DataFrame, key: str, verdict: str) -> DataFrame:
    """Kept and removed by key, and over all (a null key of its own), with percent kept."""
    out = df.rollup(key).agg(F.grouping(key).alias("is_total"), _count(F.col(verdict) == "keep", "kept"), _count(F.col(verdict) != "keep", "removed"))
    return out.withColumn("kept_pct", F.try_divide(F.col("kept") * 100, F.col("kept") + F.col("removed")))


def term_histogram(df: DataFrame, terms: str, normal) -> DataFrame:
    """Terms of a list column, normalised, by count."""
    return df.select(F.explode(terms).alias("_t")).select(normal(F.col("_t")).alias("term")).filter("term != ''").groupBy("term").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "term")


def reason_classes(df: DataFrame, reasons: Column) -> DataFrame:
    """Three exclusive classes; rows without a reason are in none."""
    a, b = F.array_contains(reasons, "too_simple"), F.array_contains(reasons, "3d_unfriendly")
    c = F.when(a & b, "both").when(a, "too_simple_only").when(b, "3d_unfriendly_only")
    return df.select(c.alias("class")).filter("class is not null").groupBy("class").agg(F.count("*").alias("count"))


def round_summary(pairs: DataFrame, round_col: str, category: str) -> DataFrame:
    """Pairs and categories of each round, and the running total; one row a round."""
    by = pairs.groupBy(round_col).agg(F.count("*").alias("pairs"), F.count_distinct(category).alias("categories"))
    return by.withColumn("running_total", F.sum("pairs").over(Window.orderBy(round_col).rowsBetween(Window.unboundedPreceding, 0)))


def grouped_lists(df: DataFrame, key: str, order: str, lists: Sequence[str]) -> DataFrame:
    """Parallel lists in order."""
    rows = F.array_sort(F.collect_list(F.struct(order, *lists)))
    out = df.groupBy(key).agg(F.min(order).alias("_first"), rows.alias("_rows"))
    return out.select(key, "_first", *[F.col(f"_rows.{c}").alias(c) for c in lists]).orderBy("_first").drop("_first")


def edit_summaries(edits: DataFrame, allowed: Column) -> DataFrame:
    """Counts of a model's allowed edits, of those with a target, and of those that
    any provider passed."""
    ok = F.coalesce(allowed, F.lit(False))
    some = F.exists(F.map_values("provider_status"), lambda s: s == PASSED)
    return edits.groupBy("model_id").agg(_count(ok, "edit_count"), _count(ok & F.col("has_target"), "target_ready_count"), _count(ok & some, "passed_count"))


def views_summary(files: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Views of the first provider by name that has any."""
    by = files.groupBy(*keys, "provider_id").agg(F.array_sort(F.collect_set("view")).alias("views"))
    return by.groupBy(*keys).agg(F.min_by(F.struct("provider_id", "views"), "provider_id").alias("_v")).select(*keys, "_v.*")


def instruction_summary(items: DataFrame) -> DataFrame:
    """Whether there are instructions, and how many; a single legacy text counts as one."""
    n = F.coalesce(F.nullif(F.size(F.coalesce("instructions", F.array().cast("array<string>"))), F.lit(0)), (clean(F.col("instruction")) != "").cast("int"))
    return items.select("id", (n > 0).alias("has_instructions"), n.alias("instructions_count"))


def scores(edits: DataFrame, col: str = "stage2_score") -> DataFrame:
    """A34."""
    return edits.select(safe_float(F.col(col)).alias("score")).filter("score is not null")


