"""O-AGG-FINAL / O-AGG-VIEW: daily roll-ups and view re-aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adledger import schemas
from adledger.functions import micros_to_units
from adledger.operators.search import ITEM


def _keys(rows: DataFrame, keys: list[str]) -> list[str]:
    """The roll-up's keys; rows dealt by item (``search.by_item``) also have that, which the ids determine."""
    return ["site", *keys, *[c for c in rows.columns if c == ITEM]]


def _money(micros_col: str, name: str):
    return micros_to_units(F.col(micros_col)).alias(name)


def daily_creatives(rows: DataFrame) -> DataFrame:
    """Final creative roll-up by site + 18 keys; the day is cast *before* grouping."""
    keys = _keys(rows, schemas.CREATIVE_KEYS)
    out = (rows.withColumn("date", F.col("date").cast("date"))
               .groupBy(*keys)
               .agg(F.sum("impressions").alias("impressions"),
                    F.sum("clicks").alias("clicks"),
                    F.sum("cost_micros").alias("cost_micros")))
    return out.select("site", *[_money("cost_micros", "cost") if c == "cost" else F.col(c)
                                for c in schemas.CREATIVE_COLUMNS])


def daily_keywords(rows: DataFrame) -> DataFrame:
    """Final keyword roll-up by site + 15 keys; MAX of max CPC, scaled after the max."""
    keys = _keys(rows, schemas.KEYWORD_KEYS)
    out = (rows.withColumn("date", F.col("date").cast("date"))
               .groupBy(*keys)
               .agg(F.sum("impressions").alias("impressions"),
                    F.sum("clicks").alias("clicks"),
                    F.sum("cost_micros").alias("cost_micros"),
                    F.max("max_cpc_micros").alias("max_cpc_micros")))
    cols = []
    for c in schemas.KEYWORD_COLUMNS:
        if c == "cost":
            cols.append(_money("cost_micros", "cost"))
        elif c == "max_cpc":
            cols.append(_money("max_cpc_micros", "max_cpc"))
        else:
            cols.append(F.col(c))
    return out.select("site", *cols)


def daily_social(rows: DataFrame) -> DataFrame:
    """O-AGG-FB: social roll-up by site + 12 keys (raw ``date``), seven sums."""
    keys = ["site"] + schemas.SOCIAL_KEYS
    out = (rows.groupBy(*keys)
               .agg(F.sum("impressions").alias("impressions"),
                    F.sum("clicks").alias("clicks"),
                    F.sum("cost_micros").alias("cost_micros"),
                    *[F.sum(c).alias(c) for c in schemas.SOCIAL_SUMS
                      if c not in ("impressions", "clicks", "cost")]))
    return out.select("site", *[_money("cost_micros", "cost") if c == "cost" else F.col(c)
                                for c in schemas.SOCIAL_COLUMNS])


def view_rollup(dataset: DataFrame, keys: list[str], sums: list[str],
                maxes: tuple[str, ...] = (), casts: dict[str, str] | None = None) -> DataFrame:
    """O-AGG-VIEW on one dataset branch: re-aggregate per site.

    The dataset is already the output of a roll-up on the same keys, so this
    aggregate finds its input hash-partitioned on its own keys and adds no
    shuffle; it is kept because the view's meaning is "re-sum per branch".
    """
    casts = casts or {}
    prepared = dataset.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c)
                                for c in dataset.columns])
    aggs = [F.sum(c).alias(c) for c in sums] + [F.max(c).alias(c) for c in maxes]
    return prepared.groupBy("site", *keys).agg(*aggs)
