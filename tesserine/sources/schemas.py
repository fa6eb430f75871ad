"""Schemas of the records, as Spark DDL."""

TIMING_ENTRY = "STRUCT<stage_name:STRING, scope:STRING, status:STRING, started_at:STRING, finished_at:STRING, elapsed_seconds:DOUBLE, attempt_index:INT, api_lane:STRING>"
_TIMINGS = f"timings MAP<STRING,{TIMING_ENTRY}>, timing_attempts MAP<STRING,ARRAY<{TIMING_ENTRY}>>"
MANIFEST = (
    "experiment_id STRING, name STRING, source_provider STRING, target_provider STRING, plan_path STRING, edit_mode STRING, gpu_id INT, started_at STRING, finished_at STRING, status STRING, "
    "totals STRUCT<object_count:BIGINT, edit_attempts_total:BIGINT, stage1_failed_count:BIGINT, stage2_entered_count:BIGINT, stage2_passed_count:BIGINT, stage2_failed_count:BIGINT>, "
    "plan STRUCT<categories:ARRAY<STRUCT<category_name:STRING, random:STRUCT<category:BOOLEAN, object:BOOLEAN>, object_count:INT, objects:ARRAY<STRING>, style_ids:ARRAY<STRING>>>>, outputs MAP<STRING,STRING>"
)
OBJECT_RECORD = (
    "experiment_id STRING, plan_path STRING, plan_index INT, object_index INT, category STRING, object_name STRING, object_key STRING, source_provider STRING, target_provider STRING, "
    "source_model_id STRING, prompt STRING, style_id STRING, edit_ids ARRAY<STRING>, target_model_ids ARRAY<STRING>, attempts_total INT, stage1_failed_count INT, stage2_entered_count INT, "
    "stage2_passed_count INT, stage2_failed_count INT, stage2_lpips_mean DOUBLE, stage2_lpips_std DOUBLE, stage2_dreamsim_mean DOUBLE, stage2_dreamsim_std DOUBLE, "
    f"final_status_counts MAP<STRING,INT>, {_TIMINGS}, created_at STRING"
)
EDIT_RECORD = (
    "experiment_id STRING, plan_index INT, category STRING, object_name STRING, source_model_id STRING, instruction_index INT, instruction_type STRING, instruction_text STRING, "
    "instruction_text_original STRING, instruction_text_effective STRING, edit_id STRING, target_model_id STRING, edit_status STRING, stage1_status STRING, stage1_reason STRING, entered_stage2 BOOLEAN, "
    "stage2_status STRING, stage2_score DOUBLE, stage2_threshold DOUBLE, stage2_metric STRING, stage2_scores_by_view MAP<STRING,DOUBLE>, final_status STRING, exclusion_reason STRING, "
    f"{_TIMINGS}, created_at STRING"
)
EVENT = "timestamp STRING, experiment_id STRING, event_type STRING, stage_name STRING, scope STRING, status STRING, attempt_index INT, elapsed_seconds DOUBLE"
MODEL_INDEX = (
    "id STRING, provider STRING, created_at STRING, has_views BOOLEAN, rendered_views_count INT, has_instructions BOOLEAN, instructions_count INT, has_edits BOOLEAN, edit_count INT, "
    "target_ready_count INT, ready_pair_count INT, category_name STRING, object_name STRING, path STRING, edited_batches ARRAY<STRUCT<edit_id:STRING, has_target_3d:BOOLEAN>>, dir_mtime_ns BIGINT, updated_at DOUBLE"
)
ASSET_FILES = "path STRING, kind STRING, id STRING, edit_id STRING, provider_id STRING, view STRING, size BIGINT, mtime_ns BIGINT"
ASSESSMENT = "category STRING, object STRING, verdict STRING, editability_score DOUBLE, has_3d_unfriendly_attrs BOOLEAN, unfriendly_reasons ARRAY<STRING>"
