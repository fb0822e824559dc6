"""The tail of the PPC datasets: one layout by item, joins that a hot key doesn't gather."""

from __future__ import annotations

from pyspark.sql import functions as F

from adledger.config import TEST_SITES, SiteConfig
from adledger.operators import search
from adledger.operators.joins import salted_left_join
from adledger.plans import ppc
from adledger.sources.testdata import seeded_reports

SF = "/root/testdata/sf0.001"


def bag(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_the_staged_rows_are_exchanged_once_and_their_attachments_once(spark):
    r = seeded_reports(spark, SF)
    stage = ppc.search_ads_stage(r.google_ads, r.google_campaign_report, TEST_SITES)
    kws = ppc.search_keywords_stage(r.google_keywords, r.google_campaign_report, TEST_SITES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = ppc.display_creatives(r.google_ads, r.google_campaign_report, TEST_SITES, stage=stage)
        plan = daily._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(__item") == 2 and plan.count("Exchange ") == 2
        rows = ppc.google_keyword_rows(kws, r.google_campaigns, TEST_SITES)
        assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(__item") == 2
        assert daily.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_attachments_equal_two_joins_and_a_coalesce(spark, mk):
    lines = [dict(adid=a, clicktype=c, impressions=i, customerid=u, campaignid=k)
             for a, c, i, u, k in [(1, "Headline", 5, 1, 1), (1, "Headline", None, 2, 1), (1, "Phone calls", 7, 1, 1),
                                   (2, "Phone calls", 3, 1, 1), (2, "Phone calls", None, 2, 1), (3, "Other", 9, 1, 1),
                                   (4, "Headline", 4, 1, 2), (4, "Headline", 6, 2, 2), (4, "Phone calls", 8, 1, 2),
                                   (None, "Headline", 11, 1, 1), (5, "Headline", None, 1, 3)]]
    report = mk.campaign_report(dict(budget=1_000_000), dict(budget=2_000_000), dict(campaignid=2, budget=3_000_000))
    stage = ppc.search_ads_stage(mk.google_ads(*lines), report, [SiteConfig("S", google=True)])
    items = search.search_ads(stage.latest)
    keys = ["site", "campaignid", "adgroupid", "adid", "day"]
    head, phone = search.split_clicktypes(stage.totals, "adid")
    want = (items.join(head, keys, "left").join(phone, keys, "left")
                 .join(stage.budget.select("site", "campaignid", "budget").distinct(), ["site", "campaignid"], "left")
                 .select(*[c for c in items.columns if c != search.TS],
                         F.coalesce("head_impressions", "phone_impressions").alias("impressions"), "budget").distinct())
    got = search.attach_impressions_and_budget(search.search_ads(search.by_item(stage.latest, "adid")), stage.attached, "adid")
    assert bag(got.select(*want.columns)) == bag(want) and want.count() > 10


def test_a_hot_key_is_dealt_over_many_tasks(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    few = spark.createDataFrame([(7, "a"), (7, "b"), (10, "c")], "k long, v string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = salted_left_join(rows, few, ["k"], ["n"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [k" in plan and "__salt" in plan.split("SortMergeJoin")[1].split("\n")[0]
        hot = out.where("v = 'a'").groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in hot) == 10_001 and max(r["count"] for r in hot) < 5_000
        assert bag(out) == bag(rows.join(few, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_match_types_come_from_one_pass_over_the_report(spark):
    r = seeded_reports(spark, SF)
    history = ppc.partner_history(r.bing_keywords, TEST_SITES, "2001-08-01")
    rows = ppc.bing_keyword_rows(r.bing_keywords, r.bing_campaigns, TEST_SITES, "2001-08-01", history=history)
    files = {f.rsplit("/", 1)[-1] for f in rows.inputFiles()}
    assert not any(f.startswith(("orders", "events")) for f in files)


def test_only_picked_rows_are_exchanged_whole(spark):
    from adledger.operators import partner
    from adledger.operators.snapshot import staged_times
    r = seeded_reports(spark, SF)
    ads = r.google_ads
    times = staged_times(ads, search.SNAP_KEYS, search.TS, "test")
    got = search.ad_fine(search.latest_rows(ads, search.SNAP_KEYS, times), TEST_SITES)
    plan = got._jdf.queryExecution().executedPlan().toString()
    pick = [x for x in plan.split("\n") if "HashJoin" in x and "_sdc_report_datetime" in x or "MergeJoin" in x and "adgroup" in x]
    assert len(pick) == 1 and "BroadcastHashJoin [site" in pick[0]
    assert bag(got) == bag(search.ad_fine(search.latest_rows(ads), TEST_SITES))
    bing = ppc.bing_creative_rows(r.bing_ads, r.bing_campaigns, TEST_SITES)
    assert any("BroadcastHashJoin [site" in x and "timeperiod" in x
               for x in bing._jdf.queryExecution().executedPlan().toString().split("\n"))
    want = partner.normalize_ads(partner.ads_with_budget(r.bing_ads.where("site != 'MIDDLE EAST'"), r.bing_campaigns))
    assert bag(bing) == bag(want.where("site != 'MIDDLE EAST'")) and want.count() > 10
