"""

Each query takes ``(spark, sf_dir)``, derives the raw reports from the seeded
tables there (``sources.testdata``) and runs the library step on the whole
tables.  Intermediate steps are exposed at the grain where they are defined;
where the library deliberately pre-aggregates (partner rows, multiplicities)
the query reports the step at a grain both forms share.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adledger import schemas
from adledger.config import TEST_SITES, sites_where, sites_with
from adledger.functions import ad_description, micros_to_units
from adledger.operators import partner, rollup, search, social
from adledger.operators.snapshot import latest_snapshot
from adledger.plans import ppc, views
from adledger.plans import social as social_plan
from adledger.session import apply_defaults, scratch_path, stage_table
from adledger.sources import kept, locations, sinks, versions
from adledger.sources.reports import for_network
from adledger.sources.testdata import Reports, seeded_reports

CONFIG = TEST_SITES
# Pinned "today" for the rolling window on the test tables (last order date).
AS_OF = "2001-08-01"
TS = "_sdc_report_datetime"


def _reports(spark: SparkSession, sf_dir: str) -> Reports:
    apply_defaults(spark)
    return seeded_reports(spark, sf_dir)


def _ad_stage(r: Reports) -> ppc.SearchStage:
    return ppc.search_ads_stage(r.google_ads, r.google_campaign_report, CONFIG)


def _kw_stage(r: Reports) -> ppc.SearchStage:
    return ppc.search_keywords_stage(r.google_keywords, r.google_campaign_report, CONFIG)


def _google(df: DataFrame) -> DataFrame:
    return for_network(df, CONFIG, "google")


def _bing(df: DataFrame) -> DataFrame:
    return for_network(df, CONFIG, "bing")


# ---------------------------------------------------------------- adapter A
def scan_ad_report(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return _google(r.google_ads)


def scan_site_sources(spark, sf_dir):
    """O-SCAN with a folder of its own for each site: two layouts, one without a third headline and with other types."""
    root = scratch_path(spark, "site-sources")
    ads, short = _google(_reports(spark, sf_dir).google_ads), sites_where(CONFIG, "has_headline3", False)
    drifted = (ads.where(F.col("site").isin(short)).drop("expandedtextadheadline3")
               .withColumn("clicks", F.col("clicks").cast("int")).withColumnRenamed("campaign", "Campaign")
               .withColumn("impressions__double", F.col("impressions").cast("double"))
               .withColumn("impressions", F.lit(None).cast("long")))
    drifted.write.partitionBy("site").parquet(f"{root}/short/google_ads")
    ads.where(~F.col("site").isin(short)).write.partitionBy("site").parquet(f"{root}/full/google_ads")
    config = [replace(c, sources={"google": f"{root}/{'short' if c.site in short else 'full'}/{{report}}/site={c.site}"})
              for c in CONFIG]
    return locations.read_site_report(spark, config, "google_ads")


def site_network_filter(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return _bing(r.bing_ads).select("site", "campaignid", "adgroupid", "adid", "timeperiod",
                                       TS, "impressions", "clicks")


def normalize_google_ads(spark, sf_dir):
    return ppc.google_creative_rows(_ad_stage(_reports(spark, sf_dir))).drop(search.ITEM)


def normalize_google_keywords(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return ppc.google_keyword_rows(_kw_stage(r), r.google_campaigns, CONFIG).drop(search.ITEM)


def platform_tag(spark, sf_dir):
    r = _reports(spark, sf_dir)
    g = ppc.google_creative_rows(_ad_stage(r)).select("site", "account_id", "platform")
    b = ppc.bing_creative_rows(r.bing_ads, r.bing_campaigns, CONFIG).select(
        "site", "account_id", "platform")
    return g.unionByName(b).distinct()


def display_exclude(spark, sf_dir):
    latest = _ad_stage(_reports(spark, sf_dir)).latest
    return search.search_ads(latest).select("site", "campaignid", "campaign").distinct()


def display_only(spark, sf_dir):
    r = _reports(spark, sf_dir)
    kw = search.keywords_with_campaign(_kw_stage(r).latest, _google(r.google_campaigns), True)
    return kw.select("site", "campaignid", "campaign").distinct()


def clicktype_impressions(spark, sf_dir):
    totals = search.clicktype_totals(_ad_stage(_reports(spark, sf_dir)).latest, "adid")
    keys = ["site", "customerid", "campaignid", "adgroupid", "adid", "day", TS]
    head = totals.where("head_rows > 0").select(
        "site", F.lit(search.HEADLINE).alias("click_type"), *keys[1:],
        F.col("head_impressions").alias("impressions"))
    phone = totals.where("phone_rows > 0").select(
        "site", F.lit(search.PHONE).alias("click_type"), *keys[1:],
        F.col("phone_impressions").alias("impressions"))
    return head.unionByName(phone)


SNAPSHOT = ("site", "adgroup", "day", TS, "campaignid", "adgroupid", "adid", "clicktype", "clicks",
            "impressions", "cost")


def latest_snapshot_adgroup_day(spark, sf_dir):
    r = _reports(spark, sf_dir)
    latest = latest_snapshot(_google(r.google_ads), search.SNAP_KEYS, TS)
    return latest.select(*SNAPSHOT)


def snapshot_kept(spark, sf_dir):
    """O-SNAP merged load by load: three loads that hold old and new rows of the same keys, the second merged twice."""
    path = scratch_path(spark, "snapshot-kept")
    ads = stage_table(_google(_reports(spark, sf_dir).google_ads).select(*SNAPSHOT).withColumn(
        "part", F.crc32(F.concat_ws(":", F.col(TS).cast("string"), "adid")) % 3), "snapshot-kept")
    for n in (2, 0, 0, 1):
        kept.merge_load(ads.where(F.col("part") == n).drop("part"), path, search.SNAP_KEYS, TS, f"load-{n}",
                        sites_with(CONFIG, "google"))
    return kept.read_kept(spark, path)


def snapshot_since(spark, sf_dir):
    """O-SNAP read again from a day on, over the rows that were kept of the days before it."""
    ads = _google(_reports(spark, sf_dir).google_ads).select(*SNAPSHOT)
    before = stage_table(latest_snapshot(ads.where(F.col("day") < "1997-01-01"), search.SNAP_KEYS, TS), "snapshot-since")
    return kept.restate_since(before, ads, search.SNAP_KEYS, TS, "day", "1996-01-01").select(*SNAPSHOT)


def ad_clicks_cost(spark, sf_dir):
    return search.search_ads(_ad_stage(_reports(spark, sf_dir)).latest)


def keyword_clicks_cost_cpc(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return search.keywords_with_campaign(_kw_stage(r).latest, _google(r.google_campaigns), False)


def impressions_attach(spark, sf_dir):
    s = _ad_stage(_reports(spark, sf_dir))
    return search.attach_impressions_and_budget(search.search_ads(search.by_item(s.latest, "adid")), s.attached,
                                                "adid").drop(search.ITEM)


def ad_description_q(spark, sf_dir):
    r = _reports(spark, sf_dir)
    p = search.prepare_ads(_google(r.google_ads), CONFIG)
    desc = F.when(F.col("three_part"),
                  ad_description("description", "desc_part2", "desc_part3")) \
            .otherwise(ad_description("description", "desc_part2"))
    return p.select("site", F.col("description").alias("description_part1"),
                    F.col("desc_part2").alias("description_part2"),
                    F.col("desc_part3").alias("description_part3"),
                    desc.alias("description")).distinct()


def micros_to_units_q(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return (_google(r.google_ads).groupBy("site", "campaignid")
            .agg(F.sum("cost").alias("cost_micros"))
            .withColumn("cost", micros_to_units("cost_micros")))


def group_by_ordinal(spark, sf_dir):
    """The final roll-up written in SQL with positional GROUP BY, as the reference does."""
    rows = ppc.google_creative_rows(_ad_stage(_reports(spark, sf_dir)))
    view = f"google_creative_rows_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT site, account_id, campaign_id, adgroup_id, creative_id, CAST(date AS DATE) AS date,
               platform, account, adgroup, campaign, sum(impressions) AS impressions,
               sum(clicks) AS clicks, CAST(sum(cost_micros) AS DOUBLE) / 1e6 AS cost, url,
               headline1, headline2, headline3, description, adgroup_state, campaign_state,
               creative_state, budget
        FROM {view}
        GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 14, 15, 16, 17, 18, 19, 20, 21, 22""")


def distinct_hidden_keys(spark, sf_dir):
    return search.all_ads_null_campaign(_ad_stage(_reports(spark, sf_dir)).latest)


def ppc_google_creatives_daily(spark, sf_dir):
    return rollup.daily_creatives(ppc.google_creative_rows(_ad_stage(_reports(spark, sf_dir))))


# ----------------------------------------------------------- adapter A-camp
def latest_snapshot_campaign(spark, sf_dir):
    r = _reports(spark, sf_dir)
    latest = latest_snapshot(_google(r.google_campaign_report), ["site", "campaignid"], TS)
    return latest.select("site", "campaignid", "campaign", "budget", TS)


def campaign_budget(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return search.campaign_budget(_google(r.google_campaign_report))


def budget_attach(spark, sf_dir):
    s = _ad_stage(_reports(spark, sf_dir))
    ads = search.search_ads(s.latest)
    b = s.budget.select("site", "campaignid", "budgetid", "budget_period", "budget")
    return ads.join(b, ["site", "campaignid"], "left").select(
        "site", "campaignid", "adgroupid", "adid", "day", "clicks", "budgetid",
        "budget_period", "budget")


def campaign_dimension_join(spark, sf_dir):
    r = _reports(spark, sf_dir)
    kw = search.keywords_with_campaign(_kw_stage(r).latest, _google(r.google_campaigns), None)
    return (kw.groupBy("site", "campaignid", "campaign", "keywordid", "day")
              .agg(F.sum("clicks").alias("clicks"), F.sum("cost_micros").alias("cost_micros"),
                   F.max("maxcpc_micros").alias("maxcpc_micros")))


# ---------------------------------------------------------- adapter B / B-camp
def _whole_rows(rows: DataFrame, additive: tuple[str, ...] = ("impressions", "clicks", "cost_micros")) -> DataFrame:
    """Rows at the grain of all their other columns: the library sums partner rows early, the SQL has them raw."""
    keys = [c for c in rows.columns if c not in additive]
    return rows.withColumn("date", F.col("date").cast("date")).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in additive])


def normalize_bing_ads(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return _whole_rows(ppc.bing_creative_rows(r.bing_ads, r.bing_campaigns, CONFIG).drop(search.ITEM))


def normalize_bing_keywords(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return _whole_rows(ppc.bing_keyword_rows(r.bing_keywords, r.bing_campaigns, CONFIG, AS_OF).drop(search.ITEM))


def rolling_31_days(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return partner.in_window(_bing(r.bing_keywords), AS_OF).select(
        "site", "campaignid", "adgroupid", "keywordid", "timeperiod", TS, "bidmatchtype")


def latest_snapshot_day(spark, sf_dir):
    r = _reports(spark, sf_dir)
    latest = latest_snapshot(_bing(r.bing_ads), partner.SNAP_KEYS, TS)
    return latest.select("site", "timeperiod", TS, "campaignid", "adid", "impressions", "clicks")


def bing_daily_budget(spark, sf_dir):
    r = _reports(spark, sf_dir)
    rows = partner.ads_with_budget(_bing(r.bing_ads), _bing(r.bing_campaigns))
    return (rows.groupBy("site", "campaignid", "timeperiod", "budget")
                .agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost_micros")]))


def latest_match_type(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return partner.latest_match_types(_bing(r.bing_keywords))


def match_type_attach(spark, sf_dir):
    r = _reports(spark, sf_dir)
    kws = _bing(r.bing_keywords)
    rows = partner.attach_match_type(
        partner.keywords_with_budget(kws, _bing(r.bing_campaigns), AS_OF),
        partner.latest_match_types(kws))
    return (rows.withColumnRenamed("bidmatchtype", "match_type")
                .groupBy("site", "keywordid", "timeperiod", "match_type")
                .agg(*[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost_micros")]))


# ------------------------------------------------------------------- A + B
def union_networks(spark, sf_dir):
    r = _reports(spark, sf_dir)
    g = ppc.google_keyword_rows(_kw_stage(r), r.google_campaigns, CONFIG).drop(search.ITEM)
    b = ppc.bing_keyword_rows(r.bing_keywords, r.bing_campaigns, CONFIG, AS_OF).drop(search.ITEM)
    return _whole_rows(g.unionByName(b))


def ppc_creatives_daily(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads,
                             r.bing_campaigns, CONFIG)


def ppc_keywords_daily(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return ppc.ppc_keywords(r.google_keywords, r.google_campaign_report, r.google_campaigns,
                            r.bing_keywords, r.bing_campaigns, CONFIG, AS_OF)


def display_creatives_daily(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return ppc.display_creatives(r.google_ads, r.google_campaign_report, CONFIG)


def display_keywords_daily(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return ppc.display_keywords(r.google_keywords, r.google_campaign_report, r.google_campaigns,
                                CONFIG)


# ---------------------------------------------------------------- adapter C
def _social(r: Reports):
    f = lambda df: for_network(df, CONFIG, "facebook")
    return f(r.social_insights), f(r.social_campaigns), f(r.social_adsets), f(r.social_ads)


def social_base(spark, sf_dir):
    ins, camps, sets, _ = _social(_reports(spark, sf_dir))
    return social.social_base(ins, camps, sets, CONFIG)


def adset_pattern_filter(spark, sf_dir):
    ins, _, _, _ = _social(_reports(spark, sf_dir))
    return ins.where(social.adset_filter(CONFIG)).select(
        "site", "campaign_id", "adset_id", "adset_name", "ad_id", "date_start")


def account_name_map(spark, sf_dir):
    return social_base(spark, sf_dir).select("site", "account_id", "account_name").distinct()


def latest_entity_status(spark, sf_dir):
    _, camps, sets, ads = _social(_reports(spark, sf_dir))
    parts = [("ad", ads), ("adset", sets), ("campaign", camps)]
    out = None
    for kind, df in parts:
        s = social.latest_entity_status(df, "id", "status").select(
            F.lit(kind).alias("entity"), "site", "id", "status")
        out = s if out is None else out.unionByName(s)
    return out


def social_status_attach(spark, sf_dir):
    ins, camps, sets, ads = _social(_reports(spark, sf_dir))
    base = social.social_base(ins, camps, sets, CONFIG)
    return social.attach_statuses(base, ads, sets, camps).select(
        "site", "ad_id", "adgroup_id", "campaign_id", "date", "ad_status", "adgroup_status",
        "campaign_status", "impressions")


def action_unnest(spark, sf_dir):
    ins, _, _, _ = _social(_reports(spark, sf_dir))
    return social.action_stats(ins)


def _pivot_q(grain):
    def q(spark, sf_dir):
        ins, _, _, _ = _social(_reports(spark, sf_dir))
        return social.action_pivot(social.action_stats(ins), grain)
    return q


def ad_latest_received(spark, sf_dir):
    ins, _, _, _ = _social(_reports(spark, sf_dir))
    return social.latest_received(ins)


def social_ads_daily(spark, sf_dir):
    r = _reports(spark, sf_dir)
    return social_plan.social_ads(r.social_insights, r.social_campaigns, r.social_adsets,
                                  r.social_ads, CONFIG)


# ------------------------------------------------------------------- views
def view_ppc_creatives(spark, sf_dir):
    return views.view_ppc_creatives(ppc_creatives_daily(spark, sf_dir))


def view_ppc_keywords(spark, sf_dir):
    return views.view_ppc_keywords(ppc_keywords_daily(spark, sf_dir))


def view_social(spark, sf_dir):
    return views.view_social(social_ads_daily(spark, sf_dir))


def view_all_ppc_creatives(spark, sf_dir):
    r = _reports(spark, sf_dir)
    stage = _ad_stage(r)   # one scan of the ad report feeds both datasets
    paid = ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads,
                             r.bing_campaigns, CONFIG, stage=stage)
    disp = ppc.display_creatives(r.google_ads, r.google_campaign_report, CONFIG, stage=stage)
    return views.view_all_ppc_creatives(paid, disp)


def view_all_ppc_keywords(spark, sf_dir):
    r = _reports(spark, sf_dir)
    stage = _kw_stage(r)
    paid = ppc.ppc_keywords(r.google_keywords, r.google_campaign_report, r.google_campaigns,
                            r.bing_keywords, r.bing_campaigns, CONFIG, AS_OF, stage=stage)
    disp = ppc.display_keywords(r.google_keywords, r.google_campaign_report, r.google_campaigns,
                                CONFIG, stage=stage)
    return views.view_all_ppc_keywords(paid, disp)


# ------------------------------------------------------------------- sinks
def publish_roundtrip(spark, sf_dir):
    """O-PUBLISH: write the creatives dataset partitioned by site, return what was written."""
    path = scratch_path(spark, "publish")
    sinks.publish(ppc_creatives_daily(spark, sf_dir), path)
    back = sinks.read_published(spark, path)
    return back.select("site", *schemas.CREATIVE_COLUMNS)


def publish_versions(spark, sf_dir):
    """O-PUBLISH by commits: all sites, then a second commit that replaces one site and empties another."""
    path = scratch_path(spark, "publish-versions")
    ds = stage_table(display_keywords_daily(spark, sf_dir), "publish-versions")
    versions.publish_version(ds, path, sites_with(CONFIG, "google"), unique_by=["site", *schemas.KEYWORD_KEYS])
    versions.publish_version(ds.where("site = 'ASIA' and clicks > 3"), path, ["ASIA", "EUROPE"])
    return versions.read_version(spark, path)


def csv_export_roundtrip(spark, sf_dir):
    """O-EXPORT: unload the keywords dataset as header-less CSV per site, read it back."""
    path = scratch_path(spark, "export")
    ds = ppc_keywords_daily(spark, sf_dir)
    ds = stage_table(ds, "export")   # one computation for all sites' directories
    sites = [c.site for c in CONFIG if c.google or c.bing]
    sinks.export_csv(ds, f"{path}/keywords", sites)
    back = sinks.read_csv_export(spark, f"{path}/keywords", ds.drop("site").schema, sites)
    return back.select("site", *schemas.KEYWORD_COLUMNS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_ad_report": scan_ad_report,
    "scan_site_sources": scan_site_sources,
    "site_network_filter": site_network_filter,
    "normalize_google_ads": normalize_google_ads,
    "normalize_google_keywords": normalize_google_keywords,
    "platform_tag": platform_tag,
    "display_exclude": display_exclude,
    "display_only": display_only,
    "clicktype_impressions": clicktype_impressions,
    "latest_snapshot_adgroup_day": latest_snapshot_adgroup_day,
    "snapshot_kept": snapshot_kept,
    "snapshot_since": snapshot_since,
    "ad_clicks_cost": ad_clicks_cost,
    "keyword_clicks_cost_cpc": keyword_clicks_cost_cpc,
    "impressions_attach": impressions_attach,
    "ad_description": ad_description_q,
    "micros_to_units": micros_to_units_q,
    "group_by_ordinal": group_by_ordinal,
    "distinct_hidden_keys": distinct_hidden_keys,
    "ppc_google_creatives_daily": ppc_google_creatives_daily,
    "latest_snapshot_campaign": latest_snapshot_campaign,
    "campaign_budget": campaign_budget,
    "budget_attach": budget_attach,
    "campaign_dimension_join": campaign_dimension_join,
    "normalize_bing_ads": normalize_bing_ads,
    "normalize_bing_keywords": normalize_bing_keywords,
    "rolling_31_days": rolling_31_days,
    "latest_snapshot_day": latest_snapshot_day,
    "bing_daily_budget": bing_daily_budget,
    "latest_match_type": latest_match_type,
    "match_type_attach": match_type_attach,
    "union_networks": union_networks,
    "ppc_creatives_daily": ppc_creatives_daily,
    "ppc_keywords_daily": ppc_keywords_daily,
    "display_creatives_daily": display_creatives_daily,
    "display_keywords_daily": display_keywords_daily,
    "social_base": social_base,
    "adset_pattern_filter": adset_pattern_filter,
    "account_name_map": account_name_map,
    "latest_entity_status": latest_entity_status,
    "social_status_attach": social_status_attach,
    "action_unnest": action_unnest,
    "action_pivot_ad": _pivot_q("ad"),
    "action_pivot_adset": _pivot_q("adset"),
    "action_pivot_campaign": _pivot_q("campaign"),
    "ad_latest_received": ad_latest_received,
    "social_ads_daily": social_ads_daily,
    "view_ppc_creatives": view_ppc_creatives,
    "view_ppc_keywords": view_ppc_keywords,
    "view_social": view_social,
    "view_all_ppc_creatives": view_all_ppc_creatives,
    "view_all_ppc_keywords": view_all_ppc_keywords,
    "publish_roundtrip": publish_roundtrip,
    "publish_versions": publish_versions,
    "csv_export_roundtrip": csv_export_roundtrip,
}
