"""plans held against the vocabulary of categories and objects, in Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entry_faults(entries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """entries (plan_id, position, random_category, random_object, category_name, objects,
    object_count) and vocabulary (category, object) -> entries with capacity (objects of the
    category) and faults, in the order in which they are looked for."""
    sizes = vocabulary.groupBy("category").agg(F.count_distinct("object").alias("capacity"))
    rows = entries.join(sizes.withColumnRenamed("category", "category_name"), "category_name", "left")
    named = rows.filter(~F.col("random_category") & ~F.col("random_object")).select("plan_id", "position", F.col("category_name").alias("category"), F.explode("objects").alias("object"))
    unknown = named.join(vocabulary, ["category", "object"], "left_anti").select("plan_id", "position", F.lit(True).alias("_unknown")).distinct()
    rows = rows.join(unknown, ["plan_id", "position"], "left")
    anywhere, name, objects, count = F.col("random_category"), F.col("category_name"), F.col("objects"), F.col("object_count")
    known = F.col("capacity").isNotNull()
    drawn, fixed = ~anywhere & known & F.col("random_object"), ~anywhere & known & ~F.col("random_object")
    filled = fixed & (F.coalesce(F.size(objects), F.lit(0)) > 0)
    rules: list[tuple[Column, str]] = [
        (anywhere & ~F.col("random_object"), "random category without random object"),
        (anywhere & name.isNotNull(), "category_name not allowed"),
        (anywhere & objects.isNotNull(), "objects not allowed"),
        (~anywhere & name.isNull(), "category_name required"),
        (~anywhere & name.isNotNull() & ~known, "unknown category"),
        (drawn & objects.isNotNull(), "objects not allowed"),
        (drawn & (count > F.col("capacity")), "object_count exceeds the category"),
        (fixed & ~filled, "objects required"),
        (filled & (count != F.size(objects)), "object_count differs from objects"),
        (filled & (F.size(F.array_distinct(objects)) < F.size(objects)), "duplicate objects"),
        (filled & F.col("_unknown").isNotNull(), "unknown objects"),
    ]
    return rows.withColumn("faults", F.array_compact(F.array(*[F.when(c, F.lit(said)) for c, said in rules]))).drop("_unknown")


def capacity_faults(entries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """plan_id, demand: the largest demand of a plan's random categories that can't have a
    category of its own; no row where all can.

    Categories that are large enough for a demand are large enough for smaller ones, so by
    Hall's condition it takes, for every demand d, as many categories of at least d objects
    that the plan doesn't fix as there are demands of at least d. Both are running counts in
    order of size: within a plan, and once over the vocabulary for all sizes that are asked."""
    sizes = vocabulary.groupBy("category").agg(F.count_distinct("object").cast("long").alias("size"))
    demands = entries.filter("random_category").select("plan_id", F.col("object_count").cast("long").alias("size"))
    fixed = entries.filter(~F.col("random_category")).select("plan_id", F.col("category_name").alias("category")).distinct().join(sizes, "category")
    falling = Window.orderBy(F.desc("size")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # one row a category, and one a size that some plan asks for: a dimension
    asked = sizes.select("size", F.lit(1).alias("n")).unionByName(demands.select("size").distinct().withColumn("n", F.lit(0)))
    large = asked.withColumn("_large", F.sum("n").over(falling)).filter("n = 0").select("size", "_large")
    both = demands.withColumns({"d": F.lit(1), "f": F.lit(0)}).unionByName(fixed.select("plan_id", "size").withColumns({"d": F.lit(0), "f": F.lit(1)}))
    own = Window.partitionBy("plan_id").orderBy(F.desc("size")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    counted = both.withColumns({"_need": F.sum("d").over(own), "_fixed": F.sum("f").over(own)}).filter("d = 1").join(large, "size")
    return counted.filter("_need > _large - _fixed").groupBy("plan_id").agg(F.max("size").alias("demand"))


def plan_faults(entries: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """plan_id, faults: all that is wrong with a plan, entries first in order of position, then
    categories fixed twice, then more entries than categories, then the demand that can't be
    met; empty for a plan that is feasible. The first is what a strict reader stops at."""
    rows = entry_faults(entries, vocabulary)
    total = vocabulary.agg(F.count_distinct("category").alias("_total"))
    fixed = F.when(~F.col("random_category"), F.col("category_name"))
    told = F.transform("faults", lambda f: F.concat(F.lit("categories["), F.col("position").cast("string"), F.lit("]: "), f))
    plans = rows.groupBy("plan_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("position", told.alias("f")))), lambda x: x["f"])).alias("own"),
        F.count(fixed).alias("_named"), F.count_distinct(fixed).alias("_distinct"), F.count_if("random_category").alias("_random"),
    )
    short = capacity_faults(entries, vocabulary)
    plans = plans.join(short, "plan_id", "left").join(F.broadcast(total))
    rest = F.array_compact(
        F.array(
            F.when(F.col("_named") > F.col("_distinct"), "duplicate category_name"),
            F.when(F.col("_distinct") + F.col("_random") > F.col("_total"), "more entries than categories"),
            F.when(F.col("demand").isNotNull(), F.concat(F.lit("no category left for object_count="), F.col("demand").cast("string"))),
        )
    )
    return plans.select("plan_id", F.concat("own", rest).alias("faults"))


def assigned(entries: DataFrame, vocabulary: DataFrame, seed: int = 0) -> DataFrame:
    """plan_id, position, category: each random entry of a plan gets a category of its own
    that no entry fixes and that has room, the largest demand first, then by position. Which
    one is drawn by hash of seed, plan, position and category, so reruns agree. A plan that
    can't be served fails the query. The pools, one entry a category, go along with each plan;
    plans are folded in the JVM, each by itself."""
    sizes = vocabulary.groupBy("category").agg(F.count_distinct("object").alias("size"))
    pools = sizes.agg(F.sort_array(F.collect_list(F.struct("category", "size"))).alias("_pools"))
    need = F.when(F.col("random_category"), F.struct((-F.col("object_count")).alias("less"), "position"))
    plans = entries.groupBy("plan_id").agg(F.sort_array(F.collect_list(need)).alias("_needs"), F.collect_set(F.when(~F.col("random_category"), F.col("category_name"))).alias("_fixed")).join(F.broadcast(pools))

    def draw(held: Column, d: Column) -> Column:
        fit = F.filter(held["free"], lambda p: p["size"] >= -d["less"])
        at = F.array_min(F.transform(fit, lambda p: F.struct(F.xxhash64(F.lit(seed), F.col("plan_id"), d["position"], p["category"]).alias("h"), p["category"].alias("category"))))["category"]
        at = F.coalesce(at, F.raise_error(F.concat(F.lit("no category has room for "), (-d["less"]).cast("string"))).cast("string"))
        took = F.array_append(held["out"], F.struct(d["position"].alias("position"), at.alias("category")))
        return F.struct(F.filter(held["free"], lambda p: p["category"] != F.element_at(took, -1)["category"]).alias("free"), took.alias("out"))

    free = F.filter("_pools", lambda p: ~F.array_contains("_fixed", p["category"]))
    none = F.array().cast("array<struct<position: int, category: string>>")
    out = F.aggregate("_needs", F.struct(free.alias("free"), none.alias("out")), draw)["out"]
    return plans.select("plan_id", F.inline(out))
