"""Adapters that present the seeded test tables as raw network reports.

The reference reads replicated advertising reports; the test bench ships
TPC-H-like tables and an event stream instead.  These functions derive
report-shaped DataFrames from those tables (FIXTURES.md section 2), so that
every query reads the given tables and its work grows with them.  They are
plain joins and aggregations; nothing here is collected to the driver.

Column choices not fixed by FIXTURES.md (URLs, texts, statuses) are arbitrary
but deterministic, and the SQL oracle builds the same columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger import schemas
from adledger.functions import to_micros

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


# Dimensions whose size is fixed by the TPC-H definition (25 nations, 5 regions):
# the only tables these adapters broadcast explicitly.
FIXED_SIZE = ("nation", "region")


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str

    def __post_init__(self) -> None:
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self._read(name)
        return self._frames[name]

    def _read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return F.broadcast(df) if name in FIXED_SIZE else df


def _month(c: str) -> Column:
    return F.trunc(F.col(c).cast("date"), "month").cast("timestamp_ntz")


def _year(c: str) -> Column:
    return F.trunc(F.col(c).cast("date"), "year").cast("timestamp_ntz")


def _conform(df: DataFrame, schema) -> DataFrame:
    """Pin column order and types to the raw-report schema (one projection)."""
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields])


def _campaign_name(suppkey: Column, s_name: Column) -> Column:
    return F.concat(F.when(suppkey % 5 == 0, F.lit("Display ")).otherwise(F.lit("Search ")), s_name)


def _search_lines(t: Tables) -> DataFrame:
    """lineitem joined to its order, part and the supplier's nation and region.

    The line items are dealt by order first: the seeded file is one row group,
    which one task would read and join alone.
    """
    li = t.lineitem.repartition("l_orderkey").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    supp = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(part, F.col("l_partkey") == F.col("p_partkey"))
              .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(t.nation.select("n_nationkey", "n_regionkey"),
                    F.col("s_nationkey") == F.col("n_nationkey"))
              .join(t.region.select("r_regionkey", "r_name"),
                    F.col("n_regionkey") == F.col("r_regionkey")))


def _search_common() -> dict[str, Column]:
    flag = F.col("l_returnflag")
    return {
        "site": F.col("r_name"),
        "account": F.col("r_name"),
        "customerid": F.col("n_regionkey"),
        "campaignid": F.col("l_suppkey"),
        "campaign": _campaign_name(F.col("l_suppkey"), F.col("s_name")),
        "adgroupid": F.col("l_suppkey") * 100 + F.col("l_partkey") % 5,
        "adgroup": F.col("p_type"),
        "clicktype": (F.when(flag == "N", "Headline").when(flag == "R", "Phone calls")
                      .otherwise("Other")),
        "clicks": F.col("l_linenumber"),
        "impressions": F.col("l_quantity"),
        "cost": to_micros("l_extendedprice"),
        "adgroupstate": F.col("l_linestatus"),
        "campaignstate": F.col("l_linestatus"),
        "day": _month("l_shipdate"),
        "_sdc_report_datetime": _year("o_orderdate"),
    }


def google_ads(t: Tables) -> DataFrame:
    """Adapter A as the search ad report."""
    cols = _search_common()
    cols.update({
        "adid": F.col("l_partkey"),
        "finalurl": F.concat(F.lit("https://example.com/p/"), F.col("l_partkey")),
        "headline1": F.col("p_name"),
        "headline2": F.col("p_brand"),
        "expandedtextadheadline3": F.col("p_type"),
        "description": F.col("p_name"),
        "expandedtextaddescription2": F.col("p_brand"),
        "descriptionline1": F.col("p_brand"),
        "descriptionline2": F.col("p_type"),
        "adstate": F.col("l_linestatus"),
    })
    df = _search_lines(t).select(*[c.alias(n) for n, c in cols.items()])
    return _conform(df, schemas.GOOGLE_ADS)


def google_keywords(t: Tables) -> DataFrame:
    """Adapter A as the search keyword report."""
    cols = _search_common()
    cols.update({
        "keywordid": F.col("l_partkey"),
        "keyword": F.col("p_name"),
        "maxcpc": to_micros("p_retailprice"),
        "matchtype": F.col("p_brand"),
        "keywordstate": F.col("l_linestatus"),
    })
    df = _search_lines(t).select(*[c.alias(n) for n, c in cols.items()])
    return _conform(df, schemas.GOOGLE_KEYWORDS)


def google_campaign_report(t: Tables) -> DataFrame:
    """Adapter A-camp as the campaign report (S3): one row per line item.

    Needs no part columns; every line item has its part, so the part join is
    left out.
    """
    li = t.lineitem.select("l_orderkey", "l_suppkey").repartition("l_orderkey")
    lines = (li.join(t.orders.select("o_orderkey", "o_orderdate"),
                     F.col("l_orderkey") == F.col("o_orderkey"))
               .join(t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
                     F.col("l_suppkey") == F.col("s_suppkey"))
               .join(t.nation.select("n_nationkey", "n_regionkey"),
                     F.col("s_nationkey") == F.col("n_nationkey"))
               .join(t.region.select("r_regionkey", "r_name"),
                     F.col("n_regionkey") == F.col("r_regionkey")))
    df = lines.select(
        F.col("r_name").alias("site"),
        F.col("l_suppkey").alias("campaignid"),
        _campaign_name(F.col("l_suppkey"), F.col("s_name")).alias("campaign"),
        F.col("l_suppkey").alias("budgetid"),
        F.lit(False).alias("hasrecommendedbudget"),
        F.lit("DAILY").alias("budgetperiod"),
        to_micros("s_acctbal").alias("budget"),
        _year("o_orderdate").alias("_sdc_report_datetime"),
    )
    return _conform(df, schemas.GOOGLE_CAMPAIGN_REPORT)


def google_campaigns(t: Tables) -> DataFrame:
    """Adapter A-camp as the campaign entity (S4): one row per supplier."""
    df = (t.supplier
          .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
          .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
          .select(F.col("r_name").alias("site"), F.col("s_suppkey").alias("id"),
                  _campaign_name(F.col("s_suppkey"), F.col("s_name")).alias("name")))
    return _conform(df, schemas.GOOGLE_CAMPAIGNS)


def _partner_orders(t: Tables) -> DataFrame:
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return (t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
                    .join(t.nation.select("n_nationkey", "n_regionkey"),
                          F.col("c_nationkey") == F.col("n_nationkey"))
                    .join(t.region.select("r_regionkey", "r_name"),
                          F.col("n_regionkey") == F.col("r_regionkey")))


def _partner_common() -> dict[str, Column]:
    status = F.when(F.col("o_orderstatus") == "F", "Active").otherwise("Paused")
    return {
        "site": F.col("r_name"),
        "accountname": F.concat(F.lit("acct"), F.col("c_nationkey")),
        "accountid": F.col("c_nationkey"),
        "campaignid": F.col("o_custkey") % 50,
        "campaignname": F.concat(F.lit("Campaign "), F.col("o_custkey") % 50),
        "adgroupid": F.col("o_custkey") % 400,
        "adgroupname": F.concat(F.lit("Group "), F.col("o_custkey") % 400),
        "impressions": F.col("o_orderkey") % 1000,
        "clicks": F.col("o_orderkey") % 50,
        "spend": F.col("o_totalprice"),
        "adgroupstatus": status,
        "campaignstatus": status,
        "timeperiod": F.col("o_orderdate"),
        "_sdc_report_datetime": F.date_add(F.trunc(F.col("o_orderdate").cast("date"), "month"),
                                           (F.col("o_orderkey") % 3).cast("int"))
                                 .cast("timestamp_ntz"),
        "__status": status,
    }


def bing_ads(t: Tables) -> DataFrame:
    """Adapter B as the search partner ad report (S5), all regions."""
    cols = _partner_common()
    status = cols.pop("__status")
    cols.update({
        "adid": F.col("o_custkey") % 1000,
        "finalurl": F.concat(F.lit("https://example.com/c/"), F.col("o_custkey") % 1000),
        "titlepart1": F.col("c_mktsegment"),
        "titlepart2": F.col("o_orderpriority"),
        "addescription": F.col("c_name"),
        "adstatus": status,
    })
    df = _partner_orders(t).select(*[c.alias(n) for n, c in cols.items()])
    return _conform(df, schemas.BING_ADS)


def bing_keywords(t: Tables) -> DataFrame:
    """Adapter B as the search partner keyword report (S6), all regions."""
    cols = _partner_common()
    status = cols.pop("__status")
    st = F.col("o_orderstatus")
    cols.update({
        "keywordid": F.col("o_custkey") % 1000,
        "keyword": F.col("c_mktsegment"),
        "bidmatchtype": (F.when(st == "O", "").when(st == "F", "Exact")
                         .when(st == "P", "Phrase")),
        "keywordstatus": status,
    })
    df = _partner_orders(t).select(*[c.alias(n) for n, c in cols.items()])
    return _conform(df, schemas.BING_KEYWORDS)


def bing_campaigns(t: Tables) -> DataFrame:
    """Adapter B-camp (S7): the campaigns that occur in the partner report."""
    df = (_partner_orders(t)
          .select(F.col("r_name").alias("site"), (F.col("o_custkey") % 50).alias("id"))
          .distinct()
          .withColumn("dailybudget", F.col("id") * 1.5))
    return _conform(df, schemas.BING_CAMPAIGNS)


# Event type -> social action type of adapter C.
ACTION_TYPES = {"click": "link_click", "view": "post_reaction", "signup": "like"}
OTHER_ACTION = "other"
ACTION_MIN_VALUE = 50


def social_insights(t: Tables) -> DataFrame:
    """Adapter C (S9): one insight row per (user, day) of the event stream.

    The action array has one entry per action type with the number of events
    of that type above the value threshold, so it holds at most four entries
    whatever the size of the group.
    """
    ev = t.events
    day = F.col("ts").cast("date")
    atype = F.col("event_type")
    mapped = F.coalesce(*[F.when(atype == k, F.lit(v)) for k, v in ACTION_TYPES.items()],
                        F.lit(OTHER_ACTION))
    big = F.col("value") > ACTION_MIN_VALUE
    kinds = list(ACTION_TYPES.values()) + [OTHER_ACTION]
    counts = [F.count(F.when(big & (mapped == k), 1)).alias(f"__n_{i}") for i, k in enumerate(kinds)]
    g = (ev.groupBy("user_id", day.alias("d"))
           .agg(F.count(F.lit(1)).alias("n"),
                F.count(F.when(atype == "click", 1)).alias("n_click"),
                F.sum(to_micros("value")).alias("spend_micros"),
                *counts))
    entries = F.array(*[
        F.struct(F.struct(F.lit(k).alias("action_type"),
                          F.col(f"__n_{i}").alias("value")).alias("value"))
        for i, k in enumerate(kinds)
    ])
    present = F.filter(entries, lambda e: e["value"]["value"] > 0)
    adset = F.col("user_id") % 20
    df = g.select(
        (F.col("user_id") % 5).cast("string").alias("site"),
        (F.col("user_id") % 10).alias("campaign_id"),
        adset.alias("adset_id"),
        F.concat(F.when(adset % 2 == 0, F.lit("Hernia Mesh ")).otherwise(F.lit("General ")),
                 adset).alias("adset_name"),
        F.col("user_id").alias("ad_id"),
        F.concat(F.lit("Ad "), F.col("user_id")).alias("ad_name"),
        F.col("d").cast("timestamp_ntz").alias("date_start"),
        F.col("n").alias("impressions"),
        F.col("n_click").alias("clicks"),
        (F.col("spend_micros") / F.lit(1e6)).alias("spend"),
        F.col("n").alias("reach"),
        F.lit(1.0).alias("frequency"),
        F.col("n_click").alias("inline_link_clicks"),
        F.when(F.size(present) > 0, present).alias("actions"),
        F.col("d").cast("timestamp_ntz").alias("_sdc_received_at"),
    )
    return _conform(df, schemas.SOCIAL_INSIGHTS)


def _entity_versions(t: Tables, id_expr: Column) -> DataFrame:
    """Adapter C-ent: one version of an entity per day it has events."""
    return (t.events
            .groupBy(id_expr.alias("id"), F.col("ts").cast("date").alias("d"))
            .agg(F.max("value").alias("vmax"))
            .select((F.col("id") % 5).cast("string").alias("site"), "id",
                    F.when(F.col("vmax") > 100, "PAUSED").otherwise("ACTIVE").alias("effective_status"),
                    F.col("d").cast("timestamp_ntz").alias("_sdc_received_at")))


def social_ads(t: Tables) -> DataFrame:
    return _conform(_entity_versions(t, F.col("user_id")), schemas.SOCIAL_ADS)


def social_adsets(t: Tables) -> DataFrame:
    return _conform(_entity_versions(t, F.col("user_id") % 20), schemas.SOCIAL_ADSETS)


def social_campaigns(t: Tables) -> DataFrame:
    df = (_entity_versions(t, F.col("user_id") % 10)
          .withColumn("account_id", F.col("site"))
          .withColumn("name", F.concat(F.lit("Campaign "), F.col("id"))))
    return _conform(df, schemas.SOCIAL_CAMPAIGNS)


class Reports:
    """All raw reports of one run; each adapter is built on first use."""

    def __init__(self, tables: Tables):
        self._t = tables

    @cached_property
    def google_ads(self) -> DataFrame:
        return google_ads(self._t)

    @cached_property
    def google_keywords(self) -> DataFrame:
        return google_keywords(self._t)

    @cached_property
    def google_campaign_report(self) -> DataFrame:
        return google_campaign_report(self._t)

    @cached_property
    def google_campaigns(self) -> DataFrame:
        return google_campaigns(self._t)

    @cached_property
    def bing_ads(self) -> DataFrame:
        return bing_ads(self._t)

    @cached_property
    def bing_keywords(self) -> DataFrame:
        return bing_keywords(self._t)

    @cached_property
    def bing_campaigns(self) -> DataFrame:
        return bing_campaigns(self._t)

    @cached_property
    def social_insights(self) -> DataFrame:
        return social_insights(self._t)

    @cached_property
    def social_campaigns(self) -> DataFrame:
        return social_campaigns(self._t)

    @cached_property
    def social_adsets(self) -> DataFrame:
        return social_adsets(self._t)

    @cached_property
    def social_ads(self) -> DataFrame:
        return social_ads(self._t)


def seeded_reports(spark: SparkSession, sf_dir: str) -> Reports:
    return Reports(Tables(spark, sf_dir))
