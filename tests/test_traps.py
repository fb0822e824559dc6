
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adledger import schemas
from adledger.config import SiteConfig
from adledger.operators.snapshot import latest_snapshot, latest_snapshot_window
from adledger.plans import ppc, social, views
from adledger.session import scratch_path
from conftest import actions, ts

CFG = [SiteConfig("S", google=True, bing=True, facebook=True,
                  social_account_id="42", account_name="s.example")]
AS_OF = dt.date(2024, 1, 10)


def creatives(mk, ads, report=None, bing=None, bing_camps=None, cfg=CFG):
    return ppc.ppc_creatives(ads, report if report is not None else mk.campaign_report(),
                             bing if bing is not None else mk.bing_ads(),
                             bing_camps if bing_camps is not None else mk.bing_campaigns({}), cfg)


def keywords(mk, kws, camps=None, bing=None, bing_camps=None, cfg=CFG, as_of=AS_OF):
    return ppc.ppc_keywords(kws, mk.campaign_report(),
                            camps if camps is not None else mk.google_campaigns(),
                            bing if bing is not None else mk.bing_keywords(),
                            bing_camps if bing_camps is not None else mk.bing_campaigns({}),
                            cfg, as_of)


def social_daily(mk, ins, camps=None, sets=None, ads=None, cfg=CFG):
    return social.social_ads(ins, camps if camps is not None else mk.social_campaigns({}),
                             sets if sets is not None else mk.social_adsets({}),
                             ads if ads is not None else mk.social_ads({}), cfg)


def _order(t):
    return [(v is None, v if v is not None else 0) for v in t]


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_order)


def test_t1_snapshot_is_keyed_by_adgroup_name(mk):
    ads = mk.google_ads(dict(campaignid=1, _sdc_report_datetime=ts(2)),
                        dict(campaignid=2, campaign="Search two", _sdc_report_datetime=ts(3)))
    assert rows(creatives(mk, ads), "campaign_id") == [(2,)]


def test_t2_ties_at_the_latest_load_are_kept(spark, mk):
    df = mk.google_ads(dict(adid=1, _sdc_report_datetime=ts(3)),
                       dict(adid=2, _sdc_report_datetime=ts(3)),
                       dict(adid=3, _sdc_report_datetime=ts(2)))
    out = latest_snapshot(df, ["site", "adgroup", "day"], "_sdc_report_datetime")
    assert rows(out, "adid") == [(1,), (2,)]


def test_t3_null_keys_and_null_load_times_drop_in_both_forms(mk):
    df = mk.google_ads(dict(adid=1), dict(adid=2, adgroup=None),
                       dict(adid=3, _sdc_report_datetime=None))
    keys, t = ["site", "adgroup", "day"], "_sdc_report_datetime"
    assert rows(latest_snapshot(df, keys, t), "adid") == [(1,)]
    assert rows(latest_snapshot_window(df, keys, t), "adid") == [(1,)]


def test_t4_display_filter_applies_after_the_snapshot(mk):
    ads = mk.google_ads(dict(campaign="Search one", _sdc_report_datetime=ts(2)),
                        dict(campaign="My DISPLAY one", _sdc_report_datetime=ts(3)))
    assert creatives(mk, ads).count() == 0


def test_t5_each_finer_row_gets_the_full_impressions(mk):
    ads = mk.google_ads(dict(adstate="enabled", clicktype="Headline", impressions=10),
                        dict(adstate="paused", clicktype="Other", impressions=3))
    out = rows(creatives(mk, ads), "creative_state", "impressions")
    assert out == [("enabled", 10), ("paused", 10)]


def test_t6_headline_first_then_phone_other_types_never(mk):
    ads = mk.google_ads(dict(adid=1, clicktype="Headline", impressions=10),
                        dict(adid=1, clicktype="Phone calls", impressions=4),
                        dict(adid=2, clicktype="Phone calls", impressions=4),
                        dict(adid=3, clicktype="Other", impressions=9, clicks=5))
    out = rows(creatives(mk, ads), "creative_id", "impressions", "clicks")
    assert out == [(1, 10, 2), (2, 4, 1), (3, 0, 5)]


def test_t7_distinct_collapses_equal_texts_from_different_parts(mk):
    ads = mk.google_ads(dict(description="a b", expandedtextaddescription2=""),
                        dict(description="a", expandedtextaddescription2="b"))
    assert rows(creatives(mk, ads), "description", "clicks") == [("a b", 1)]


def test_t8_display_dataset_groups_without_the_campaign_name(mk):
    ads = mk.google_ads(dict(campaign="Search one"), dict(campaign="Search renamed"))
    out = ppc.display_creatives(ads, mk.campaign_report(), CFG)
    assert rows(out, "campaign", "clicks") == [(None, 2)]
    assert out.schema["campaign"].dataType == T.StringType()


def test_t9_all_creatives_view_counts_search_ads_twice(mk):
    ads = mk.google_ads({})
    paid = creatives(mk, ads)
    disp = ppc.display_creatives(ads, mk.campaign_report(), CFG)
    assert views.view_all_ppc_creatives(paid, disp).count() == 2
    only = ppc.display_creatives(ads, mk.campaign_report(), CFG, only_display=True)
    assert views.view_all_ppc_creatives(paid, only).count() == 1


def test_t10_null_campaign_is_neither_display_nor_search(mk):
    assert creatives(mk, mk.google_ads(dict(campaign=None))).count() == 0
    camps = mk.google_campaigns(dict(name=None))
    kws = mk.google_keywords({})
    assert keywords(mk, kws, camps).count() == 0
    assert ppc.display_keywords(kws, mk.campaign_report(), camps, CFG).count() == 0


def test_t11_several_budgets_fan_out(mk):
    report = mk.campaign_report(dict(budgetid=5, budget=7_000_000),
                                dict(budgetid=6, budget=9_000_000),
                                dict(budgetid=6, budget=1_000_000, _sdc_report_datetime=ts(1)))
    out = rows(creatives(mk, mk.google_ads({}), report), "budget", "clicks")
    assert out == [(7.0, 1), (9.0, 1)]


def test_t12_dimension_joins_without_snapshot_pick(mk):
    kws = mk.google_keywords(dict(campaignid=1), dict(campaignid=2, keywordid=101))
    camps = mk.google_campaigns(dict(id=1), dict(id=1))
    assert rows(keywords(mk, kws, camps), "campaign_id", "clicks") == [(1, 2)]
    bing = mk.bing_ads({})
    out = creatives(mk, mk.google_ads(dict(site="X")), bing=bing,
                    bing_camps=mk.bing_campaigns({}, {}))
    assert rows(out, "platform", "clicks") == [("Bing", 4)]


def test_t13_match_type_joined_on_keyword_id_only(mk):
    bing = mk.bing_keywords(dict(campaignid=1, bidmatchtype="Exact"),
                            dict(campaignid=2, bidmatchtype="Phrase"))
    camps = mk.bing_campaigns(dict(id=1), dict(id=2))
    out = keywords(mk, mk.google_keywords(dict(site="X")), bing=bing, bing_camps=camps)
    assert rows(out, "campaign_id", "match_type", "clicks") == [
        (1, "Exact", 2), (1, "Phrase", 2), (2, "Exact", 2), (2, "Phrase", 2)]


def test_t14_empty_or_null_match_type_gives_null(mk):
    bing = mk.bing_keywords(dict(bidmatchtype=""), dict(bidmatchtype=None, timeperiod=ts(2)))
    out = keywords(mk, mk.google_keywords(dict(site="X")), bing=bing)
    assert {r.match_type for r in out.collect()} == {None}


def test_t15_money_units_per_network(mk):
    out = creatives(mk, mk.google_ads(dict(cost=1_500_000)), bing=mk.bing_ads(dict(spend=1.5)),
                    bing_camps=mk.bing_campaigns({}))
    assert rows(out, "platform", "cost") == [("AdWords", 1.5), ("Bing", 1.5)]


def test_t16_micros_become_double_units(mk):
    out = creatives(mk, mk.google_ads(dict(cost=5)))
    assert out.schema["cost"].dataType == T.DoubleType()
    assert rows(out, "cost") == [(5e-06,)]


def test_t17_partner_columns_are_aligned_by_name(mk):
    bing = mk.bing_ads({})
    shuffled = bing.select(*reversed(bing.columns))
    a = creatives(mk, mk.google_ads(dict(site="X")), bing=bing, bing_camps=mk.bing_campaigns({}))
    b = creatives(mk, mk.google_ads(dict(site="X")), bing=shuffled,
                  bing_camps=mk.bing_campaigns({}))
    assert rows(a, *schemas.CREATIVE_COLUMNS) == rows(b, *schemas.CREATIVE_COLUMNS)


def test_t18_missing_headline3_is_a_string_null(spark, mk):
    cfg = [SiteConfig("S", google=True, has_headline3=False)]
    out = creatives(mk, mk.google_ads({}), cfg=cfg)
    assert out.schema["headline3"].dataType == T.StringType()
    path = scratch_path(spark, "t18")
    out.write.parquet(path)
    back = spark.read.parquet(path)
    assert back.schema["headline3"].dataType == T.StringType()
    assert rows(back, "headline3") == [(None,)]


def test_t19_trim_strips_unicode_whitespace(mk):
    ads = mk.google_ads(dict(description="\t a\u00a0", expandedtextaddescription2=""))
    assert rows(creatives(mk, ads), "description") == [("a",)]


def test_t20_rolling_window_keeps_31_days(mk):
    days = [AS_OF - dt.timedelta(days=31), AS_OF - dt.timedelta(days=30), AS_OF,
            AS_OF + dt.timedelta(days=1)]
    bing = mk.bing_keywords(*[dict(timeperiod=dt.datetime.combine(d, dt.time())) for d in days])
    out = keywords(mk, mk.google_keywords(dict(site="X")), bing=bing)
    assert rows(out, "date") == [(days[1],), (days[2],)]


def test_t21_day_is_cast_before_the_final_grouping(mk):
    ads = mk.google_ads(dict(day=ts(1, 1)), dict(day=ts(1, 5)))
    assert rows(creatives(mk, ads), "date", "clicks") == [(dt.date(2024, 1, 1), 2)]


def test_t22_rows_differing_only_in_reach_both_count(mk):
    ins = mk.insights(dict(reach=8), dict(reach=9))
    assert rows(social_daily(mk, ins), "impressions") == [(20,)]


def test_t23_actions_are_not_deduplicated(mk):
    ins = mk.insights(dict(actions=actions(("like", 1))), dict(actions=actions(("like", 1))))
    assert rows(social_daily(mk, ins), "clicks", "likes_ad") == [(2, 2)]


def test_t24_no_actions_is_null_other_actions_is_zero(mk):
    ins = mk.insights(dict(ad_id=1), dict(ad_id=2, actions=actions(("other", 3))))
    out = rows(social_daily(mk, ins, ads=mk.social_ads(dict(id=1), dict(id=2))),
               "ad_id", "post_reactions_ad", "likes_ad")
    assert out == [(1, None, None), (2, 0, 0)]


def test_t25_status_ties_fan_out(mk):
    ads = mk.social_ads(dict(effective_status="ACTIVE"), dict(effective_status="PAUSED"))
    out = rows(social_daily(mk, mk.insights({}), ads=ads), "ad_status", "impressions")
    assert out == [("ACTIVE", 10), ("PAUSED", 10)]


def test_t26_unknown_account_id_maps_to_null(mk):
    camps = mk.social_campaigns(dict(account_id="999"))
    assert rows(social_daily(mk, mk.insights({}), camps=camps), "account_name") == [(None,)]
    assert rows(social_daily(mk, mk.insights({})), "account_name") == [("s.example",)]


def test_t27_views_never_merge_sites(mk):
    cfg = [SiteConfig("S", google=True), SiteConfig("T", google=True)]
    ads = mk.google_ads(dict(site="S"), dict(site="T"))
    report = mk.campaign_report(dict(site="S"), dict(site="T"))
    ds = ppc.ppc_creatives(ads, report, mk.bing_ads(), mk.bing_campaigns(), cfg)
    out = views.view_ppc_creatives(ds)
    assert "site" not in out.columns
    assert rows(out, "clicks") == [(1,), (1,)]


def test_t28_renamed_campaign_versions_fan_out(mk):
    camps = mk.social_campaigns(dict(name="Camp"), dict(name="Camp 2", _sdc_received_at=ts(2)))
    out = rows(social_daily(mk, mk.insights({}), camps=camps), "campaign_name", "impressions")
    assert out == [("Camp", 10), ("Camp 2", 10)]


def test_site_network_filter_drops_unconfigured_sites(mk):
    cfg = [SiteConfig("S", google=True, bing=False)]
    out = creatives(mk, mk.google_ads({}), bing=mk.bing_ads({}),
                    bing_camps=mk.bing_campaigns({}), cfg=cfg)
    assert rows(out, "platform") == [("AdWords",)]


def test_adset_pattern_applies_to_its_site_only(mk):
    cfg = [SiteConfig("S", facebook=True, adset_like="%hernia%mesh%"),
           SiteConfig("T", facebook=True)]
    ins = mk.insights(dict(adset_name="Hernia - Mesh ads"), dict(adset_name="Other", ad_id=2),
                      dict(site="T", adset_name="Other"))
    camps = mk.social_campaigns({}, dict(site="T"))
    sets = mk.social_adsets({}, dict(site="T"))
    out = rows(social_daily(mk, ins, camps=camps, sets=sets, cfg=cfg), "site", "adgroup_name")
    assert out == [("S", "Hernia - Mesh ads"), ("T", "Other")]


@pytest.mark.parametrize("grain,cols", [("ad", 4), ("adset", 3), ("campaign", 2)])
def test_action_pivot_grains(mk, grain, cols):
    from adledger.operators.social import action_pivot, action_stats
    ins = mk.insights(dict(actions=actions(("like", 2), ("link_click", 1), ("post_reaction", 5))))
    out = action_pivot(action_stats(ins), grain).collect()[0]
    assert (out[f"post_reactions_{grain}"], out[f"link_clicks_{grain}"],
            out[f"likes_{grain}"]) == (5, 1, 2)
    assert len(out) == 1 + cols + 3


def test_t1_correction_snapshot_by_adgroup_id(mk):
    from adledger.operators import search
    ads = mk.google_ads(dict(campaignid=1, adgroupid=10, _sdc_report_datetime=ts(2)),
                        dict(campaignid=2, adgroupid=20, campaign="Search two",
                             _sdc_report_datetime=ts(3)))
    st = ppc.search_ads_stage(ads, mk.campaign_report(), CFG,
                              snapshot_keys=search.SNAP_KEYS_BY_ID)
    out = ppc.ppc_creatives(ads, mk.campaign_report(), mk.bing_ads(), mk.bing_campaigns({}),
                            CFG, stage=st)
    assert rows(out, "campaign_id") == [(1,), (2,)]


def test_t13_correction_match_type_on_all_three_ids(mk):
    bing = mk.bing_keywords(dict(campaignid=1, bidmatchtype="Exact"),
                            dict(campaignid=2, bidmatchtype="Phrase"))
    camps = mk.bing_campaigns(dict(id=1), dict(id=2))
    out = ppc.ppc_keywords(mk.google_keywords(dict(site="X")), mk.campaign_report(),
                           mk.google_campaigns(), bing, camps, CFG, AS_OF,
                           match_keys=("campaignid", "adgroupid", "keywordid"))
    assert rows(out, "campaign_id", "match_type", "clicks") == [(1, "Exact", 2), (2, "Phrase", 2)]


def test_register_views_for_sql(spark, mk):
    ads, kws = mk.google_ads({}), mk.google_keywords({})
    paid = creatives(mk, ads)
    disp = ppc.display_creatives(ads, mk.campaign_report(), CFG)
    kw = keywords(mk, kws)
    dkw = ppc.display_keywords(kws, mk.campaign_report(), mk.google_campaigns(), CFG)
    soc = social_daily(mk, mk.insights({}))
    views.register_views(paid, disp, kw, dkw, soc)
    got = spark.sql("SELECT count(*) AS n FROM view_all_ppc_creatives").first().n
    assert got == 2
    assert spark.sql("SELECT sum(clicks) AS c FROM view_social").first().c == 2


def test_site_config_loads_from_json(tmp_path):
    import json
    from adledger.config import load_sites
    p = tmp_path / "sites.json"
    p.write_text(json.dumps([{"site": "A", "google": True, "has_headline3": False},
                             {"site": "B", "facebook": True, "social_account_id": "7",
                              "account_name": "b.example", "adset_like": "%x%"}]))
    cfg = load_sites(str(p))
    assert cfg[0] == SiteConfig("A", google=True, has_headline3=False)
    assert cfg[1].adset_like == "%x%"
    p.write_text(json.dumps([{"site": "C", "googel": True}]))
    with pytest.raises(ValueError):
        load_sites(str(p))
