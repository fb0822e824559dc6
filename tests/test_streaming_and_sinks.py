"""Sinks and the streaming refresh, on the seeded sf0.001 tables."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from adledger import schemas
from adledger.config import TEST_SITES, SiteConfig
from adledger.plans import ppc
from adledger.session import scratch_path, staged_paths
from adledger.sources import sinks
from adledger.sources.reports import read_report
from adledger.sources.testdata import seeded_reports
from adledger.streaming.refresh import refresh_on_new_loads

SF = "/root/testdata/sf0.001"


def bag(df, cols):
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def test_publish_partitions_by_site_and_overwrites_only_written_sites(spark, mk):
    path = scratch_path(spark, "publish-test")
    first = mk.google_ads(dict(site="S"), dict(site="T"))
    sinks.publish(first.select("site", "adid", "clicks"), path)
    sinks.publish(mk.google_ads(dict(site="S", clicks=9)).select("site", "adid", "clicks"), path)
    back = sinks.read_published(spark, path)
    assert bag(back, ["site", "clicks"]) == bag(
        spark.createDataFrame([("S", 9), ("T", 1)], "site string, clicks long"), ["site", "clicks"])


def test_csv_export_round_trip_keeps_nulls_and_empty_strings(spark, mk):
    path = scratch_path(spark, "export-test")
    df = mk.google_ads(dict(headline1=None, headline2="")).select("site", "adid", "headline1",
                                                                   "headline2", "day")
    sinks.export_csv(df, path, ["S"])
    back = sinks.read_csv_export(spark, path, df.drop("site").schema, ["S"])
    assert bag(back, df.columns) == bag(df, df.columns)


def test_refresh_republishes_sites_with_new_loads(spark):
    cfg = [c for c in TEST_SITES if c.google]
    r = seeded_reports(spark, SF)
    raw_dir = scratch_path(spark, "raw-ads")
    r.google_ads.write.partitionBy("site").parquet(raw_dir)
    camp_dir = scratch_path(spark, "raw-campaign-report")
    r.google_campaign_report.write.partitionBy("site").parquet(camp_dir)
    target = scratch_path(spark, "published")

    def build(sites):
        sub = [c for c in cfg if c.site in sites]
        ads = read_report(spark, raw_dir, schemas.GOOGLE_ADS, sites)
        report = read_report(spark, camp_dir, schemas.GOOGLE_CAMPAIGN_REPORT, sites)
        stage = ppc.search_ads_stage(ads, report, sub)
        return ppc.display_creatives(ads, report, sub, stage=stage)

    ckpt = scratch_path(spark, "refresh-ckpt")
    q = refresh_on_new_loads(spark, raw_dir, schemas.GOOGLE_ADS, build, target, ckpt)
    q.awaitTermination(300)
    expected_all = build([c.site for c in cfg])
    cols = expected_all.columns
    assert bag(spark.read.parquet(target).select(*cols), cols) == bag(expected_all, cols)

    # A newer load for one site: only that site is republished, with the new numbers.
    newer = (read_report(spark, raw_dir, schemas.GOOGLE_ADS, ["ASIA"])
             .withColumn("_sdc_report_datetime", F.lit(dt.datetime(2030, 1, 1)))
             .withColumn("clicks", F.col("clicks") + 1))
    newer.write.mode("append").partitionBy("site").parquet(raw_dir)
    q = refresh_on_new_loads(spark, raw_dir, schemas.GOOGLE_ADS, build, target, ckpt)
    q.awaitTermination(300)
    expected_all = build([c.site for c in cfg])
    assert bag(spark.read.parquet(target).select(*cols), cols) == bag(expected_all, cols)


def test_staging_table_is_deleted_on_release(spark, mk):
    st = ppc.search_ads_stage(mk.google_ads({}), mk.campaign_report(),
                              [SiteConfig("S", google=True)])
    paths = [p.removeprefix("file:") for d in (st.latest, st.totals) for p in staged_paths(d)]
    assert paths and all(os.path.isdir(p) for p in paths)
    assert st.latest.count() == 1
    st.release()
    assert not any(os.path.exists(p) for p in paths)


def test_daily_job_publishes_every_dataset(spark):
    from adledger.plans import daily
    from adledger.plans.catalog import QUERIES
    r = seeded_reports(spark, SF)
    root, held = scratch_path(spark, "daily"), staged_paths()
    paths = daily.run_daily(r, TEST_SITES, root, as_of="2001-08-01")
    assert set(paths) >= set(daily.DATASETS) and len(paths) == 10
    assert staged_paths() == held   # its own staging is dropped, nothing else
    view = spark.read.parquet(paths["view_ppc_creatives"])
    assert view.count() == QUERIES["view_ppc_creatives"](spark, SF).count()
    got = spark.read.parquet(paths["ppc_keywords"])
    want = QUERIES["ppc_keywords_daily"](spark, SF)
    assert bag(got.select(*want.columns), want.columns) == bag(want, want.columns)
    assert spark.read.parquet(paths["social_ads"]).count() == \
        QUERIES["social_ads_daily"](spark, SF).count()


def test_read_reports_from_site_partitioned_folders(spark):
    from adledger.sources.reports import read_reports
    r = seeded_reports(spark, SF)
    root = scratch_path(spark, "raw-root")
    for name in ("google_ads", "google_keywords", "google_campaign_report", "google_campaigns",
                 "bing_ads", "bing_keywords", "bing_campaigns", "social_insights",
                 "social_campaigns", "social_adsets", "social_ads"):
        getattr(r, name).write.partitionBy("site").parquet(f"{root}/{name}")
    raw = read_reports(spark, root, sites=["ASIA", "3"])
    got = ppc.ppc_creatives(raw.google_ads, raw.google_campaign_report, raw.bing_ads,
                            raw.bing_campaigns, TEST_SITES)
    want = ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads,
                             r.bing_campaigns, TEST_SITES).where("site = 'ASIA'")
    assert bag(got, want.columns) == bag(want, want.columns)
    assert {x.site for x in raw.social_insights.select("site").distinct().collect()} == {"3"}


def test_published_sites_stay_strings_and_emptied_sites_are_cleared(spark):
    path = scratch_path(spark, "publish-sites")
    rows = spark.createDataFrame([("01", 1), ("2", 2), ("a b", 3)], "site string, n long")
    sinks.publish(rows, path)
    assert bag(sinks.read_published(spark, path), ["site", "n"]) == bag(rows, ["site", "n"])
    sinks.publish(rows.where("site = '2'"), path, sites=["01", "2"])
    assert bag(sinks.read_published(spark, path), ["site", "n"]) == bag(rows.where("site != '01'"), ["site", "n"])


def test_csv_export_changes_no_text_and_leaves_other_sites(spark):
    path = scratch_path(spark, "export-texts")
    texts = ["  pad  ", "two\nlines", "\\N", "\\", "\\\\N", 'say "x", y', "", None, "'", "a,b", "\r\n", "é\t"]
    rows = spark.createDataFrame([("01", i, t) for i, t in enumerate(texts)] + [("b", 99, "z")],
                                 "site string, i long, t string")
    sinks.export_csv(rows, path, ["01", "b"])
    schema = rows.drop("site").schema
    assert bag(sinks.read_csv_export(spark, path, schema, ["01", "b"]), rows.columns) == bag(rows, rows.columns)
    sinks.export_csv(rows.where("false"), path, ["b"])
    assert bag(sinks.read_csv_export(spark, path, schema, ["01", "b"]), rows.columns) == bag(
        rows.where("site = '01'"), rows.columns)


def test_first_configured_account_name_holds_and_spend_is_distinct_as_reported(spark):
    from adledger.config import account_name
    config = [SiteConfig("a", social_account_id="7", account_name="first"),
              SiteConfig("b", social_account_id="7", account_name="second")]
    ids = spark.createDataFrame([("7",), ("8",), (None,)], "i string")
    got = [r[0] for r in ids.select(account_name(F.col("i"), config)).collect()]
    assert got == ["first", None, None]


def test_todays_window_follows_utc_in_any_session_zone(spark):
    from adledger.functions import in_rolling_window
    for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            today = dt.datetime.now(dt.timezone.utc).date()
            days = spark.createDataFrame([(today - dt.timedelta(days=n),) for n in (-1, 0, 30, 31)], "d date")
            assert [r[0] for r in days.select(in_rolling_window("d", None)).collect()] == [False, True, True, False]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_only_a_local_session_gets_a_folder_of_its_own():
    from adledger.session import _local_folder
    assert os.path.isdir(_local_folder("local[2]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            _local_folder(master)
