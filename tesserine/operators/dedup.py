"""Latest per key, upserts, quotas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import optional_text


def _first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], time: str, ordinal: str) -> DataFrame:
    """The row with the greatest time of each key; the first in file order on ties. Null
    times count as empty text. row_number() = 1 is cut down before the shuffle."""
    return _first_of(df, keys, [F.coalesce(F.col(time).cast("string"), F.lit("")).desc(), F.col(ordinal).asc()])


def latest_then_filter(df: DataFrame, keys: Sequence[str], time: str, ordinal: str, keep: Column) -> DataFrame:
    """An older row never stands in for one that fails."""
    return latest_per_key(df, keys, time, ordinal).filter(keep)


def filter_then_latest(df: DataFrame, keys: Sequence[str], time: str, ordinal: str, keep: Column) -> DataFrame:
    """The latest of those that pass."""
    return latest_per_key(df.filter(keep), keys, time, ordinal)


def last_write(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """W02."""
    return _first_of(df, keys, [F.col(ordinal).desc()])


def keyed_upsert(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """The last value of each key at its first position (column position)."""
    values = [c for c in df.columns if c not in (*keys, ordinal)]
    row = F.max_by(F.struct(*values), F.col(ordinal)).alias("_v")
    return df.groupBy(*keys).agg(F.min(ordinal).alias("position"), row).select(*keys, "position", "_v.*")


def record_key(model_id: Column, *fallback: Column) -> Column:
    """The id, else the parts of the fallback."""
    return F.coalesce(optional_text(model_id), F.concat_ws("::", *[F.coalesce(c.cast("string"), F.lit("")) for c in fallback]))


def quota(df: DataFrame, group: Sequence[str], kind: str, order: Sequence[Column], limits: dict[str, int], above: int) -> DataFrame:
    """groups of more than `above` rows keep so many of each kind, and no other kind;
    smaller groups stay whole."""
    # dealt by group and ranked before it is counted, so that one shuffle and one sort serve both;
    # _rn is never 0, and counting it so keeps the optimiser from turning the two about
    ranked = df.repartition(*group).withColumn("_rn", F.row_number().over(Window.partitionBy(*group, kind).orderBy(*order)))
    ranked = ranked.withColumn("_n", F.count(F.nullif("_rn", F.lit(0))).over(Window.partitionBy(*group)))
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
    return ranked.filter((F.col("_n") <= above) | (F.col("_rn") <= F.coalesce(limit[F.col(kind)], F.lit(0)))).drop("_n", "_rn")


def capped_work(candidates: DataFrame, done: DataFrame, keys: Sequence[str], group: Sequence[str], order: Sequence[Column], cap: int, force: bool = False) -> DataFrame:
    """Label is skip (done already), limited (beyond the cap of its group, counted over
    those not done) or run."""
    marked = candidates.join(done.select(*keys).distinct().withColumn("_done", F.lit(True)), list(keys), "left")
    skip = F.coalesce(F.col("_done"), F.lit(False)) if not force else F.lit(False)
    marked = marked.withColumn("_skip", skip)
    rank = F.row_number().over(Window.partitionBy(*group, "_skip").orderBy(*order))
    return marked.withColumn("label", F.when(F.col("_skip"), "skip").when(rank <= cap, "run").otherwise("limited")).drop("_done", "_skip")


def edits_to_delete(edits: DataFrame, instructions: DataFrame, views: int = 6, limits: dict[str, int] | None = None, above: int = 4) -> DataFrame:
    """model_id, edit_id, reason. edits (model_id, edit_id, png_count, instruction) go that
    lack views, and of the rest those whose instruction isn't one that its model keeps of
    instructions (model_id, kind, text, pos); an edit without an instruction or a model
    without any says nothing. A model keeps `above` texts at most, so its list is short."""
    kept = quota(instructions, ["model_id"], "kind", [F.col("pos")], limits or {"remove": 2, "replace": 2}, above)
    kept = kept.groupBy("model_id").agg(F.collect_set(F.trim(F.coalesce("text", F.lit("")))).alias("_kept"))
    orphan = (F.col("instruction") != "") & (F.size("_kept") > 0) & ~F.array_contains("_kept", F.col("instruction"))
    few = F.coalesce("png_count", F.lit(0)) != views
    told = F.when(few, F.concat(F.lit("Incomplete: "), F.coalesce("png_count", F.lit(0)).cast("string"), F.lit(f"/{views} views"))).when(orphan, "Orphan: instruction not in kept list")
    return edits.join(kept, "model_id", "left").select("model_id", "edit_id", told.alias("reason")).filter("reason IS NOT NULL")
