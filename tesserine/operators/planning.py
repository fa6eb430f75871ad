"""Work lists, pairs, allocation and sampling."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_reason


def with_asset(df: DataFrame, assets: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose asset exists."""
    return df.join(assets.select(*on), list(on), "left_semi")


def work_list(ids: DataFrame, done: DataFrame, on: Sequence[str], force: bool = False) -> DataFrame:
    """Rows without output; all of them if forced."""
    return ids if force else ids.join(done.select(*on), list(on), "left_anti")


def reuse_lookup(wanted: DataFrame, edits: DataFrame, allowed: Column) -> DataFrame:
    """For each wanted (model_id, instruction) the least allowed edit with the same text."""
    key = F.lower(F.trim("instruction"))
    known = edits.filter(allowed).groupBy("model_id", key.alias("_k")).agg(F.min("edit_id").alias("edit_id"))
    return wanted.withColumn("_k", key).join(known, ["model_id", "_k"], "left").drop("_k")


def reasons(df: DataFrame, rules: Sequence[tuple[Column, str]], accepted: str = "accepted") -> DataFrame:
    """The common form of J12 and J13: the first rule a row breaks."""
    return df.withColumn("reason", F.coalesce(first_reason(rules), F.lit(accepted)))


def reason_counts(df: DataFrame, rules: Sequence[tuple[Column, str]], accepted: str = "accepted") -> DataFrame:
    return reasons(df, rules, accepted).groupBy("reason").agg(F.count("*").alias("count"))


def attach_allowed(batches: DataFrame, allowed: DataFrame, keys: Sequence[str], model: str, values: Sequence[str], order: str) -> DataFrame:
    """Batches in the allowed set with its values, regrouped by model; models without
    one vanish."""
    rows = batches.join(allowed.select(*keys, *values), list(keys))
    return rows.groupBy(model).agg(F.array_sort(F.collect_list(F.struct(order, *values))).alias("batches"), F.count("*").alias("batch_count"))


def membership_index(runs: DataFrame, records: DataFrame, on: Sequence[str], key: str, sets: Sequence[str]) -> DataFrame:
    """The distinct values of several columns that each key meets, sorted."""
    return runs.join(records, list(on)).groupBy(key).agg(*[F.array_sort(F.collect_set(c)).alias(f"{c}_list") for c in sets])


def reverse_lookup(categories: DataFrame) -> DataFrame:
    """Categories (pos, category, objects) -> object_name, category: the first category
    of each object."""
    rows = categories.select("pos", "category", F.explode("objects").alias("object_name"))
    return rows.groupBy("object_name").agg(F.min_by("category", "pos").alias("category"))


def assemble(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """Parents with a list of structs from each child, gathered before the join;
    a parent without children has empty lists."""
    out = parent
    for name, child in children.items():
        cols = [c for c in child.columns if c != key]
        kind = child.select(F.array(F.struct(*cols)).alias("x")).schema["x"].dataType
        lists = child.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
        out = out.join(lists, key, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))
    return out


def style_priority(styles: DataFrame, mapping: DataFrame) -> DataFrame:
    """Styles (style_id, weight), mapping (category, pos, style_id) -> category, style_id,
    rank from 0: by weight, then by how many categories have the style, then by place. Keys
    that start with _ are no categories."""
    rows = mapping.filter(~F.col("category").startswith("_")).join(styles, "style_id")
    cover = rows.groupBy("style_id").agg(F.count("*").alias("_cover"))
    w = Window.partitionBy("category").orderBy(F.desc("weight"), F.desc("_cover"), "pos")
    return rows.join(cover, "style_id").withColumn("rank", F.row_number().over(w) - 1).select("category", "style_id", "rank")


def matrix_pairs(objects: DataFrame, priority: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Objects (category, object_name), priority (category, style_id, rank) -> index,
    round, category, object_name, style_id. Round r pairs every object with its category's
    style of rank r. The index runs over rounds, categories, objects; it adds up counts a
    round and category, so no window holds more than one of them, or the list of them."""
    p = priority if max_rounds is None else priority.filter(F.col("rank") < max_rounds)
    rows = objects.join(p, "category").withColumnRenamed("rank", "round")
    cells = rows.groupBy("round", "category").agg(F.count("*").alias("n"))
    cells = cells.withColumn("_start", F.coalesce(F.sum("n").over(Window.orderBy("round", "category").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("round", "category").orderBy("object_name"))
    return rows.withColumn("_i", inside).join(cells, ["round", "category"]).withColumn("index", F.col("_start") + F.col("_i") - 1).select("index", "round", "category", "object_name", "style_id")


def balanced_allocation(pools: DataFrame, total: int) -> DataFrame:
    """Pools (category, pool_size, pos) -> category, object_count, pool_size. An even
    split, capped by the pools; what is over goes to the largest pools first, but not to
    categories that got nothing. One row a category, so its windows are over a dimension."""
    by = Window.orderBy(F.desc("pool_size"), "pos")
    all_ = Window.partitionBy()
    n = F.count("*").over(all_)
    base = pools.withColumn("_i", F.row_number().over(by) - 1).withColumn("_even", F.floor(F.lit(total) / n) + (F.col("_i") < F.lit(total) % n).cast("int"))
    base = base.withColumn("_count", F.least("_even", "pool_size")).filter("_count > 0")
    left = F.lit(total) - F.sum("_count").over(all_)
    spare = F.col("pool_size") - F.col("_count")
    before = F.coalesce(F.sum(spare).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = F.least(spare, F.greatest(F.lit(0), left - before))
    return base.withColumn("object_count", (F.col("_count") + more).cast("long")).select("category", "object_count", "pool_size")


def zipped(left: DataFrame, right: DataFrame, key: str, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Rows of both sides by position within key, as far as both go."""
    number = lambda df, order: df.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return number(left, left_order).join(number(right, right_order), [key, "position"])


def batched(df: DataFrame, order: Sequence[str], size: int, key: str) -> DataFrame:
    """Batches of a fixed size within key."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1) / size))


def diverse_sample(candidates: DataFrame, order: Sequence[str], category: str, item: str, count: int) -> DataFrame:
    """In order, first rows whose category and item are both new, then rows whose item is
    new, up to count. Each choice depends on those before it, so the last step is one pass in
    one task over at most count rows a category: of each (category, item) only the first row
    can be chosen, and of a category only its first count items, since all before a later
    one would have to be taken already."""
    w = Window.partitionBy(category, item).orderBy(*order)
    firsts = candidates.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    of_category = Window.partitionBy(category).orderBy(*order)
    firsts = firsts.withColumn("_rn", F.row_number().over(of_category)).filter(F.col("_rn") <= count).drop("_rn")
    schema = firsts.schema

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches) if (batches := list(batches)) else None
        if rows is None or rows.empty:
            return
        rows = rows.sort_values(list(order), kind="stable")
        seen_c, seen_i, chosen = set(), set(), []
        for strict in (True, False):
            for at, c, i in zip(range(len(rows)), rows[category], rows[item], strict=True):
                if len(chosen) < count and i not in seen_i and not (strict and c in seen_c):
                    chosen.append(at)
                    seen_c.add(c)
                    seen_i.add(i)
        yield rows.iloc[chosen]

    return firsts.coalesce(1).mapInPandas(choose, schema)


def _hash_order(seed: int, *cols: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *cols).cast("binary"))


def hash_sample(df: DataFrame, count: int, seed: int, *keys: str) -> DataFrame:
    """A sample without replacement, the same each time."""
    return df.orderBy(_hash_order(seed, *keys), *keys).limit(count)


def sample_per_group(df: DataFrame, group: str, count: Column, seed: int, *keys: str) -> DataFrame:
    """So many rows of each group, without replacement."""
    w = Window.partitionBy(group).orderBy(_hash_order(seed, *keys), *keys)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= count).drop("_rn")


def weighted_choice(requests: DataFrame, styles: DataFrame, seed: int, pinned: str | None = None, pinned_share: float = 0.4) -> DataFrame:
    """Requests (request_id, category), styles (category, style_id, weight) -> a style for
    each request. The pinned one, where the category has it, has its share, and the rest goes
    by weight to the others; alone it is always taken. All weights 0 count the same. A
    category without styles draws from all of them."""
    unit = lambda salt: F.conv(F.substring(_hash_order(seed, F.lit(salt), "request_id"), 1, 8), 16, 10).cast("long") / F.lit(2.0**32)
    known = styles.select(F.col("category").alias("_c")).distinct()
    r = requests.join(known, F.col("category") == F.col("_c"), "left").withColumn("_own", F.coalesce("_c", F.lit("\0all"))).drop("_c").withColumn("_u", unit("u")).withColumn("_p", unit("p"))
    every = styles.groupBy("style_id").agg(F.max("weight").alias("weight")).withColumn("category", F.lit("\0all"))
    s = styles.select("category", "style_id", "weight").unionByName(every.select("category", "style_id", "weight"))
    # Sides: the pinned style, and the others. A side's number picks first, then its weights.
    s = s.withColumn("_side", (F.col("style_id") == F.lit(pinned)) if pinned is not None else F.lit(False))
    w = Window.partitionBy("category", "_side")
    positive = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(1.0)), F.lit(0.0))
    s = s.withColumn("_w", F.when(F.sum(positive).over(w) > 0, positive).otherwise(F.lit(1.0))).withColumn("_hi", F.sum("_w").over(w.orderBy("style_id").rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_w").over(w))
    has = s.groupBy(F.col("category").alias("_own")).agg(F.max("_side").alias("_pin"), F.min("_side").alias("_only"))
    r = r.join(has, "_own").withColumn("_take", F.col("_only") | (F.col("_pin") & (F.col("_p") < pinned_share)))
    j = r.join(s.drop("weight").withColumnRenamed("category", "_own"), "_own").filter(F.col("_side") == F.col("_take"))
    j = j.filter((F.col("_u") * F.col("_all") >= F.col("_hi") - F.col("_w")) & (F.col("_u") * F.col("_all") < F.col("_hi")))
    return j.select("request_id", "category", "style_id")


def best_pair(scores: Column, axes: dict[str, tuple[str, str]]) -> Column:
    """Axes in order of the sum of their two scores, ties by place; the last is out."""
    rows = F.array(*[F.struct((-(scores[a] + scores[b])).alias("s"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, (a, b)) in enumerate(axes.items())])
    names = F.transform(F.array_sort(rows), lambda x: x["n"])
    return F.struct(F.slice(names, 1, len(axes) - 1).alias("kept"), F.element_at(names, -1).alias("excluded"))


def assign_categories(slots: list[tuple[int, int]], pools: dict[str, int], seed: int = 0) -> dict[int, str]:
    """W20, on the driver over a plan: slots (position, demand) get distinct categories with
    room, largest demand first; raises if none is left."""
    import random

    r, free, out = random.Random(seed), dict(pools), {}
    for pos, need in sorted(slots, key=lambda s: (-s[1], s[0])):
        fit = sorted(c for c, n in free.items() if n >= need)
        if not fit:
            raise ValueError(f"no category has room for {need}")
        out[pos] = r.choice(fit)
        del free[out[pos]]
    return out


def feasible(demands: Sequence[int], pools: Sequence[int]) -> bool:
    """F28, on the driver: can each demand have a pool of its own that is large enough?"""
    left = sorted(pools)
    for need in sorted(demands):
        at = next((i for i, p in enumerate(left) if p >= need), None)
        if at is None:
            return False
        del left[at]
    return True
