"""Reports read from a location of its own for each site and network, with drifting columns."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from adledger import schemas
from adledger.config import TEST_SITES, SiteConfig, load_sites
from adledger.plans import ppc, social
from adledger.session import scratch_path
from adledger.sources import locations
from adledger.sources.testdata import seeded_reports

SF = "/root/testdata/sf0.001"


def bag(df, cols=None):
    return sorted(repr(tuple(r[c] for c in cols or df.columns)) for r in df.collect())


def test_two_sites_with_other_columns_and_types_give_one_pinned_report(spark, mk):
    root = scratch_path(spark, "locations")
    a = mk.google_ads(dict(site="A", clicks=3), dict(site="A", adid=7, headline1=None)).drop("site")
    b = (mk.google_ads(dict(site="B", clicks=5)).drop("site", "expandedtextadheadline3")
           .withColumn("clicks", F.col("clicks").cast("int")).withColumn("cost", F.col("cost").cast("string"))
           .withColumnRenamed("campaign", "Campaign").withColumn("unread", F.lit("x")))
    a.write.parquet(f"{root}/one/google_ads")
    b.write.parquet(f"{root}/lake/google_ads/of=b")
    config = [SiteConfig("A", google=True, sources={"google": f"{root}/one"}),
              SiteConfig("B", google=True, sources={"google": f"{root}/lake/{{report}}/of=b"}),
              SiteConfig("C", bing=True, sources={"google": f"{root}/nowhere", "bing": f"{root}/nowhere"})]
    got = locations.read_site_report(spark, config, "google_ads")
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in schemas.GOOGLE_ADS]
    want = mk.google_ads(dict(site="A", clicks=3), dict(site="A", adid=7, headline1=None),
                         dict(site="B", clicks=5, expandedtextadheadline3=None))
    assert bag(got) == bag(want)
    files = got.where("site = 'A'").inputFiles()
    assert files and all("/one/" in f for f in files)


def test_twin_columns_fill_nulls_and_columns_added_later_are_found(spark, mk):
    root = scratch_path(spark, "locations-twins")
    old = mk.google_keywords(dict(maxcpc=None, keywordid=1)).drop("site", "matchtype")
    new = mk.google_keywords(dict(maxcpc=None, keywordid=2), dict(keywordid=3)).drop("site").withColumn(
        "maxcpc__bigint", F.lit(9).cast("long"))
    old.write.parquet(f"{root}/google_keywords")
    new.write.mode("append").parquet(f"{root}/google_keywords")
    got = locations.read_site_report(spark, [SiteConfig("S", google=True, sources={"google": root})], "google_keywords")
    assert {(r.keywordid, r.maxcpc, r.matchtype) for r in got.collect()} == {
        (1, None, None), (2, 9, "Exact"), (3, 2_000_000, "Exact")}


def test_nested_records_are_matched_by_name(spark, mk):
    root = scratch_path(spark, "locations-nested")
    rows = spark.sql("""select 1L as campaign_id, 11L as adset_id, 111L as ad_id,
        array(named_struct('value', named_struct('value', 5, 'extra', true, 'action_type', 'like')), null) as Actions""")
    rows.write.parquet(f"{root}/social_insights")
    config = [SiteConfig("S", facebook=True, sources={"facebook": root})]
    got = locations.read_site_report(spark, config, "social_insights").first()
    assert got.actions[0].value.action_type == "like" and got.actions[0].value.value == 5 and got.actions[1] is None
    assert got.site == "S" and got.spend is None


def test_values_that_do_not_fit_and_missing_locations_are_errors(spark, mk):
    root = scratch_path(spark, "locations-bad")
    mk.google_campaigns({}).drop("site").withColumn("id", F.lit("no number")).write.parquet(f"{root}/google_campaigns")
    config = [SiteConfig("S", google=True, sources={"google": root})]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        locations.read_site_report(spark, config, "google_campaigns").collect()
    with pytest.raises(ValueError, match="no location"):
        locations.read_site_report(spark, [SiteConfig("S", google=True)], "google_campaigns")
    mk.google_campaigns({}).drop("site").withColumn("name", F.array("name")).write.parquet(f"{root}/x/google_campaigns")
    with pytest.raises(TypeError, match="name"):
        locations.read_site_report(spark, [SiteConfig("S", google=True, sources={"google": f"{root}/x"})], "google_campaigns")


def test_no_site_with_the_network_gives_an_empty_report(spark):
    got = locations.read_site_report(spark, [SiteConfig("S", facebook=True)], "bing_ads")
    assert got.count() == 0 and got.columns == schemas.BING_ADS.names


def test_datasets_from_locations_equal_those_from_one_lake(spark, tmp_path):
    r = seeded_reports(spark, SF)
    root = scratch_path(spark, "locations-all")
    for name in locations.REPORTS:
        getattr(r, name).write.partitionBy("site").parquet(f"{root}/{name}")
    picked = [c for c in TEST_SITES if c.site in ("ASIA", "MIDDLE EAST", "4")]
    entries = [{"site": c.site, "google": c.google, "bing": c.bing, "facebook": c.facebook,
                "three_part_description": c.three_part_description, "adset_like": c.adset_like,
                "social_account_id": c.social_account_id, "account_name": c.account_name,
                "sources": {n: f"{root}/{{report}}/site={c.site}" for n in ("google", "bing", "facebook") if getattr(c, n)}}
               for c in picked]
    path = os.path.join(tmp_path, "sites.json")
    with open(path, "w") as f:
        json.dump(entries, f)
    config = load_sites(path)
    assert [replace(c, sources={}) for c in config] == picked
    raw = locations.read_site_reports(spark, config)
    for got, want in (
            (ppc.ppc_creatives(raw.google_ads, raw.google_campaign_report, raw.bing_ads, raw.bing_campaigns, config),
             ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads, r.bing_campaigns, picked)),
            (social.social_ads(raw.social_insights, raw.social_campaigns, raw.social_adsets, raw.social_ads, config),
             social.social_ads(r.social_insights, r.social_campaigns, r.social_adsets, r.social_ads, picked))):
        assert bag(got, want.columns) == bag(want) and got.count() > 0
