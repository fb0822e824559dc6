"""Cross-checks on the seeded tables (sf0.001): equivalent forms, multi-site, plans, oracle."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from adledger.config import TEST_SITES
from adledger.operators import search
from adledger.operators.snapshot import latest_snapshot, latest_snapshot_window
from adledger.plans import ppc
from adledger.plans.catalog import QUERIES
from adledger.sources.testdata import seeded_reports

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def bag(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_snapshot_join_form_equals_window_form(spark):
    ads = seeded_reports(spark, SF).google_ads
    keys, ts = search.SNAP_KEYS, search.TS
    a = latest_snapshot(ads, keys, ts)
    b = latest_snapshot_window(ads, keys, ts).select(*a.columns)
    assert a.count() > 0
    assert bag(a) == bag(b)


def test_latest_distinct_rows_gather_no_group(spark):
    from adledger.operators.snapshot import latest_rows_distinct
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("a", 2, None), (None, 3, "z"), ("b", None, "u"), ("b", 1, "v")]
    out = latest_rows_distinct(spark.createDataFrame(rows, "k string, t int, v string"), ["k"], "t", ["v"])
    assert sorted(map(tuple, out.collect()), key=repr) == [("a", "y"), ("a", None), ("b", "v")]
    assert "collect_" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_snapshot_on_fine_rows_keeps_the_raw_rows_kept(spark):
    """Pre-aggregating before the snapshot pick keeps exactly the reference's rows."""
    r = seeded_reports(spark, SF)
    raw = latest_snapshot(r.google_ads, search.SNAP_KEYS, search.TS)
    fine = search.latest_rows(search.ad_fine(r.google_ads, TEST_SITES))
    assert raw.agg({"clicks": "sum"}).first()[0] == fine.agg({"clicks": "sum"}).first()[0]
    assert (raw.select(*search.SNAP_KEYS, search.TS).distinct().count()
            == fine.select(*search.SNAP_KEYS, search.TS).distinct().count())


def test_one_job_for_all_sites_equals_one_job_per_site(spark):
    r = seeded_reports(spark, SF)
    everything = ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads,
                                   r.bing_campaigns, TEST_SITES)
    per_site = None
    for cfg in TEST_SITES:
        if not cfg.google:
            continue
        one = ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads,
                                r.bing_campaigns, [cfg])
        per_site = one if per_site is None else per_site.unionByName(one)
    assert bag(everything) == bag(per_site)


def test_display_split_is_a_partition_of_named_campaigns(spark):
    r = seeded_reports(spark, SF)
    st = ppc.search_keywords_stage(r.google_keywords, r.google_campaign_report, TEST_SITES)
    total = search.keywords_with_campaign(st.latest, r.google_campaigns, None).count()
    ex = search.keywords_with_campaign(st.latest, r.google_campaigns, False).count()
    only = search.keywords_with_campaign(st.latest, r.google_campaigns, True).count()
    assert ex + only == total and ex > 0 and only > 0


@pytest.mark.parametrize("name", ["ppc_creatives_daily", "ppc_keywords_daily",
                                  "social_ads_daily", "view_all_ppc_creatives"])
def test_plans_stay_in_the_jvm_and_never_cross_join(spark, name):
    df = QUERIES[name](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "FlatMapGroupsInPandas"):
        assert bad not in plan, bad


def test_entry_runs_on_the_smoke_tables(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "cost" in df.columns


@pytest.mark.parametrize("name", ["ppc_creatives_daily", "ppc_keywords_daily",
                                  "display_creatives_daily", "display_keywords_daily",
                                  "social_ads_daily", "latest_match_type", "csv_export_roundtrip"])
def test_matches_the_sql_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(ocols)
    order = [ocols.index(c) for c in df.columns]

    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    srows = sorted(repr(tuple(norm(v) for v in r)) for r in df.collect())
    orows = sorted(repr(tuple(norm(r[i]) for i in order)) for r in orows)
    assert srows == orows


def test_every_query_has_an_oracle():
    from oracle_sql import oracle_queries
    assert set(QUERIES) == set(oracle_queries()) <= set(entry.queries())


def test_views_are_the_identity_on_their_datasets(spark):
    from adledger import schemas
    from adledger.plans import views
    r = seeded_reports(spark, SF)
    ds = ppc.ppc_creatives(r.google_ads, r.google_campaign_report, r.bing_ads,
                           r.bing_campaigns, TEST_SITES)
    assert bag(views.view_ppc_creatives(ds)) == bag(ds.select(*schemas.CREATIVE_COLUMNS))


def test_library_code_never_pulls_data_to_the_driver():
    import pathlib
    import re
    root = pathlib.Path(__file__).resolve().parent.parent / "adledger"
    allowed = {"streaming/refresh.py"}   # distinct sites of a micro-batch: bounded by the config
    pattern = re.compile(r"\.(collect|toPandas|toLocalIterator|take|head)\(|localCheckpoint|udf\(")
    offenders = [str(p.relative_to(root)) for p in root.rglob("*.py")
                 if p.parent.name != "llm" and pattern.search(p.read_text())
                 and str(p.relative_to(root)) not in allowed]
    assert offenders == []
