"""Ranked search, ordering and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import epoch


def ranked_search(df: DataFrame, query: str, id_col: str, others: Sequence[str], order: Sequence[Column], limit: int = 20) -> DataFrame:
    """exact id, then id prefix, then part of the id or another column; top `limit`."""
    q = query.strip().lower()
    key = F.lower(F.col(id_col).cast("string"))
    part = key.contains(q)
    for c in others:
        part = part | F.coalesce(F.lower(c).contains(q), F.lit(False))
    rank = F.when(key == q, 0).when(key.startswith(q), 1).when(part, 2)
    return df.withColumn("rank", rank).filter("rank is not null").orderBy("rank", *order).limit(limit)


def page(df: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """One page."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_with_more(df: DataFrame, order: Sequence[Column], number: int, size: int) -> tuple[DataFrame, bool]:
    """A page and whether there is another, from one row more."""
    rows = df.orderBy(*order).offset((number - 1) * size).limit(size + 1)
    return rows.limit(size), rows.count() > size


def priority_page(payload: DataFrame, index: DataFrame, on: Sequence[str], priority: Column, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """Payloads with their index entry, priority rows first."""
    return page(payload.join(index, list(on), "left"), [F.when(priority, 0).otherwise(1), *order], number, size)


def by_ids(df: DataFrame, ids: DataFrame, key: str, most: int = 50) -> DataFrame:
    """Ids (pos, key) -> rows in the order asked, at most so many; unknown ids drop out."""
    return ids.orderBy("pos").limit(most).join(df, key).orderBy("pos")


def newest_first(created: Column, key: Column) -> list[Column]:
    """By instant, then text, then id, all descending; what can't be read comes last."""
    return [epoch(created).desc_nulls_last(), created.desc_nulls_last(), key.desc()]


def ends(df: DataFrame, order: Sequence[str], count: int) -> DataFrame:
    """The first and last rows of an order, with side low or high."""
    low = df.orderBy(*order).limit(count).withColumn("side", F.lit("low"))
    return low.unionByName(df.orderBy(*[F.desc(c) for c in order]).limit(count).withColumn("side", F.lit("high")))


def newest_tasks(live: DataFrame, stored: DataFrame, key: str, created: str, count: int = 100) -> DataFrame:
    """Live tasks win over stored ones of the same id; the newest `count`."""
    rows = live.withColumn("_p", F.lit(1)).unionByName(stored.withColumn("_p", F.lit(0)), allowMissingColumns=True)
    values = [c for c in rows.columns if c not in (key, "_p")]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*values), "_p").alias("_v")).select(key, "_v.*")
    return best.orderBy(F.desc_nulls_last(created), F.desc(key)).limit(count)
