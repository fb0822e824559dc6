"""Property tests: the rewritten plans against brute force on random small inputs.

The library pre-aggregates before the snapshot pick and replaces dimension
fan-out by multiplicities.  Here random reports with duplicate dimension ids,
tied load times, empty and null match types are pushed through the library
and through a direct pure-Python reading of the reference semantics (raw rows,
self-join snapshot, raw joins, sums at the end).
"""

from __future__ import annotations

import datetime as dt
import os
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adledger import schemas
from adledger.config import SiteConfig
from adledger.operators.snapshot import latest_snapshot, latest_snapshot_window
from adledger.plans import ppc
from conftest import BING_KW, frame

AS_OF = dt.date(2024, 1, 10)
DAYS = [dt.datetime(2024, 1, d) for d in (1, 2, 9)] + [dt.datetime(2023, 12, 1)]
LOADS = [dt.datetime(2024, 1, 20, h) for h in (1, 2)]
CFG = [SiteConfig("S", bing=True), SiteConfig("T", bing=True)]
# A handful of fixed examples per run keeps the suite fast and reproducible;
# set ADLEDGER_PROPERTY_EXAMPLES to search further.
SETTINGS = settings(max_examples=int(os.environ.get("ADLEDGER_PROPERTY_EXAMPLES", "6")),
                    derandomize="ADLEDGER_PROPERTY_EXAMPLES" not in os.environ, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

kw_rows = st.lists(st.fixed_dictionaries({
    "site": st.sampled_from(["S", "T"]),
    "campaignid": st.integers(1, 2),
    "adgroupid": st.integers(1, 2),
    "keywordid": st.integers(1, 3),
    "bidmatchtype": st.sampled_from(["", None, "Exact", "Phrase"]),
    "timeperiod": st.sampled_from(DAYS),
    "_sdc_report_datetime": st.sampled_from(LOADS),
    "clicks": st.integers(0, 5),
    "impressions": st.integers(0, 9),
    "spend": st.sampled_from([0.5, 1.25, 2.0]),
}), min_size=1, max_size=12)
camp_rows = st.lists(st.fixed_dictionaries({
    "site": st.sampled_from(["S", "T"]),
    "id": st.integers(1, 2),
    "dailybudget": st.sampled_from([1.5, 3.0]),
}), min_size=1, max_size=5)


def brute_force_bing_keywords(kws, camps, as_of):
    lo = as_of - dt.timedelta(days=30)
    win = [r for r in kws if lo <= r["timeperiod"].date() <= as_of]
    latest = {}
    for r in win:
        k = (r["site"], r["timeperiod"])
        latest[k] = max(latest.get(k, r["_sdc_report_datetime"]), r["_sdc_report_datetime"])
    base = [r for r in win if r["_sdc_report_datetime"] == latest[(r["site"], r["timeperiod"])]]
    joined = [dict(r, budget=c["dailybudget"]) for r in base for c in camps
              if c["site"] == r["site"] and c["id"] == r["campaignid"]]
    last_day = {}
    for r in kws:
        if r["bidmatchtype"] not in ("", None):
            k = (r["site"], r["campaignid"], r["adgroupid"], r["keywordid"])
            last_day[k] = max(last_day.get(k, r["timeperiod"]), r["timeperiod"])
    mt = {(r["site"], r["campaignid"], r["adgroupid"], r["keywordid"], r["bidmatchtype"])
          for r in kws if r["bidmatchtype"] not in ("", None)
          and last_day[(r["site"], r["campaignid"], r["adgroupid"], r["keywordid"])]
          == r["timeperiod"]}
    out = defaultdict(lambda: [0, 0, 0])
    for r in joined:
        matches = [m[4] for m in mt if m[0] == r["site"] and m[3] == r["keywordid"]] or [None]
        for m in matches:
            key = (r["site"], r["campaignid"], r["adgroupid"], r["keywordid"],
                   r["timeperiod"].date(), m, r["budget"])
            acc = out[key]
            acc[0] += r["impressions"]
            acc[1] += r["clicks"]
            acc[2] += round(r["spend"] * 1_000_000)
    return sorted((k + (v[0], v[1], v[2] / 1e6)) for k, v in out.items())


@SETTINGS
@given(kws=kw_rows, camps=camp_rows)
def test_partner_keywords_equal_brute_force(spark, mk, kws, camps):
    kw_df = frame(spark, schemas.BING_KEYWORDS, BING_KW, *kws)
    camp_df = frame(spark, schemas.BING_CAMPAIGNS, None, *camps)
    out = ppc.ppc_keywords(mk.google_keywords(dict(site="X")), mk.campaign_report(),
                           mk.google_campaigns(), kw_df, camp_df, CFG, AS_OF)
    got = sorted((r.site, r.campaign_id, r.adgroup_id, r.keyword_id, r.date, r.match_type,
                  r.budget, r.impressions, r.clicks, r.cost) for r in out.collect())
    assert got == brute_force_bing_keywords(kws, camps, AS_OF)


snap_rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None]),
                               st.sampled_from(LOADS + [None]), st.integers(0, 3)),
                     min_size=1, max_size=15)


@SETTINGS
@given(rows=snap_rows)
def test_snapshot_join_form_equals_window_form_and_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, d int, ts timestamp_ntz, v int")
    keys = ["k", "d"]
    by_join = sorted(map(tuple, latest_snapshot(df, keys, "ts").select("k", "d", "ts", "v")
                         .collect()))
    by_window = sorted(map(tuple, latest_snapshot_window(df, keys, "ts")
                           .select("k", "d", "ts", "v").collect()))
    top = {}
    for k, d, t, v in rows:
        if None not in (k, d, t):
            top[(k, d)] = max(top.get((k, d), t), t)
    brute = sorted(r for r in rows if None not in r[:3] and top[(r[0], r[1])] == r[2])
    assert by_join == by_window == brute


gk_rows = st.lists(st.fixed_dictionaries({
    "site": st.sampled_from(["S", "T"]),
    "campaignid": st.integers(1, 2),
    "adgroupid": st.integers(1, 2),
    "adgroup": st.sampled_from(["g1", "g2"]),
    "keywordid": st.integers(1, 2),
    "clicktype": st.sampled_from(["Headline", "Phone calls", "Other"]),
    "clicks": st.integers(0, 3),
    "impressions": st.integers(0, 9),
    "cost": st.integers(0, 3_000_000),
    "maxcpc": st.sampled_from([None, 1_000_000, 2_500_000]),
    "keywordstate": st.sampled_from(["on", "off"]),
    "day": st.sampled_from(DAYS[:2]),
    "_sdc_report_datetime": st.sampled_from(LOADS),
}), min_size=1, max_size=12)
gcamp_rows = st.lists(st.fixed_dictionaries({
    "site": st.sampled_from(["S", "T"]),
    "id": st.integers(1, 2),
    "name": st.sampled_from(["Search a", "Search b", "My Display", None]),
}), min_size=1, max_size=5)
report_rows = st.lists(st.fixed_dictionaries({
    "site": st.sampled_from(["S", "T"]),
    "campaignid": st.integers(1, 2),
    "budget": st.sampled_from([1_000_000, 2_000_000]),
    "_sdc_report_datetime": st.sampled_from(LOADS),
}), min_size=0, max_size=4)


def brute_force_search_keywords(kws, camps, report):
    top = {}
    for r in kws:
        k = (r["site"], r["adgroup"], r["day"])
        top[k] = max(top.get(k, r["_sdc_report_datetime"]), r["_sdc_report_datetime"])
    latest = [r for r in kws if r["_sdc_report_datetime"] == top[(r["site"], r["adgroup"], r["day"])]]
    items = defaultdict(lambda: [0, 0, None])
    for r in latest:
        for c in camps:
            if (c["site"], c["id"]) != (r["site"], r["campaignid"]) or c["name"] is None:
                continue
            if "display" in c["name"].lower():
                continue
            k = (r["site"], r["campaignid"], r["adgroupid"], r["keywordid"], r["adgroup"],
                 c["name"], r["keywordstate"], r["day"], r["_sdc_report_datetime"])
            acc = items[k]
            acc[0] += r["clicks"]
            acc[1] += r["cost"]
            if r["maxcpc"] is not None:
                acc[2] = r["maxcpc"] if acc[2] is None else max(acc[2], r["maxcpc"])
    imps = {}
    for kind in ("Headline", "Phone calls"):
        agg = defaultdict(int)
        for r in latest:
            if r["clicktype"] == kind:
                agg[(r["site"], r["campaignid"], r["adgroupid"], r["keywordid"], r["day"],
                     r["_sdc_report_datetime"])] += r["impressions"]
        imps[kind] = agg
    btop = {}
    for r in report:
        k = (r["site"], r["campaignid"])
        btop[k] = max(btop.get(k, r["_sdc_report_datetime"]), r["_sdc_report_datetime"])
    budgets = {(r["site"], r["campaignid"], r["budget"] / 1e6) for r in report
               if btop[(r["site"], r["campaignid"])] == r["_sdc_report_datetime"]}
    final = set()
    for k, (clicks, cost, cpc) in items.items():
        site, camp, ag, kw, _, _, _, day, _ = k
        def matches(kind):
            return [v for kk, v in imps[kind].items() if kk[:5] == (site, camp, ag, kw, day)] or [None]
        bs = [b for (s, c, b) in budgets if (s, c) == (site, camp)] or [None]
        for h in matches("Headline"):
            for p in matches("Phone calls"):
                for b in bs:
                    imp = h if h is not None else p
                    final.add(k[:8] + (clicks, cost, cpc or 0, imp, b))
    out = defaultdict(lambda: [0, 0, 0, 0])
    for site, camp, ag, kw, adgroup, name, state, day, clicks, cost, cpc, imp, b in final:
        acc = out[(site, camp, ag, kw, day.date(), adgroup, name, state, b)]
        acc[0] += imp or 0
        acc[1] += clicks
        acc[2] += cost
        acc[3] = max(acc[3], cpc)
    return sorted(k + (v[0], v[1], v[2] / 1e6, v[3] / 1e6) for k, v in out.items())


@SETTINGS
@given(kws=gk_rows, camps=gcamp_rows, report=report_rows)
def test_search_keywords_equal_brute_force(spark, mk, kws, camps, report):
    from conftest import CAMPAIGN_REPORT, GOOGLE_KW
    cfg = [SiteConfig("S", google=True), SiteConfig("T", google=True)]
    kw_df = frame(spark, schemas.GOOGLE_KEYWORDS, GOOGLE_KW, *kws)
    camp_df = frame(spark, schemas.GOOGLE_CAMPAIGNS, None, *camps)
    rep_df = frame(spark, schemas.GOOGLE_CAMPAIGN_REPORT, CAMPAIGN_REPORT, *report)
    out = ppc.ppc_keywords(kw_df, rep_df, camp_df, mk.bing_keywords(), mk.bing_campaigns(), cfg,
                           AS_OF)
    got = sorted((r.site, r.campaign_id, r.adgroup_id, r.keyword_id, r.date, r.adgroup,
                  r.campaign, r.keyword_state, r.budget, r.impressions, r.clicks, r.cost,
                  r.max_cpc) for r in out.collect())
    assert got == brute_force_search_keywords(kws, camps, report)


ga_rows = st.lists(st.fixed_dictionaries({
    "site": st.sampled_from(["S", "T"]),
    "campaignid": st.integers(1, 2),
    "campaign": st.sampled_from(["Search a", "Search b", "Big DISPLAY", None]),
    "adgroupid": st.integers(1, 2),
    "adgroup": st.sampled_from(["g1", "g2"]),
    "adid": st.integers(1, 2),
    "clicktype": st.sampled_from(["Headline", "Phone calls", "Other"]),
    "clicks": st.integers(0, 3),
    "impressions": st.integers(0, 9),
    "cost": st.sampled_from([0, 500_000, 1_250_000]),
    "description": st.sampled_from(["a b", "a", " a", None]),
    "expandedtextaddescription2": st.sampled_from(["b", "", None]),
    "adstate": st.sampled_from(["on", "off"]),
    "day": st.sampled_from([dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 5),
                            dt.datetime(2024, 1, 2)]),
    "_sdc_report_datetime": st.sampled_from(LOADS),
}), min_size=1, max_size=12)


def _trim2(a, b):
    return f"{a or ''} {b or ''}".strip(" \t\n\x0b\f\r ")


def brute_force_search_creatives(ads, report):
    top = {}
    for r in ads:
        k = (r["site"], r["adgroup"], r["day"])
        top[k] = max(top.get(k, r["_sdc_report_datetime"]), r["_sdc_report_datetime"])
    latest = [r for r in ads if r["_sdc_report_datetime"] == top[(r["site"], r["adgroup"], r["day"])]]
    groups = defaultdict(lambda: [0, 0])
    for r in latest:
        if r["campaign"] is None or "display" in r["campaign"].lower():
            continue
        k = (r["site"], r["campaignid"], r["adgroupid"], r["adid"], r["adgroup"], r["campaign"],
             r["description"], r["expandedtextaddescription2"], r["adstate"], r["day"],
             r["_sdc_report_datetime"])
        groups[k][0] += r["clicks"]
        groups[k][1] += r["cost"]
    items = {(site, camp, ag, ad, agn, cname, _trim2(d1, d2), state, day, ts, c, m)
             for (site, camp, ag, ad, agn, cname, d1, d2, state, day, ts), (c, m) in groups.items()}
    imps = {}
    for kind in ("Headline", "Phone calls"):
        agg = defaultdict(int)
        for r in latest:
            if r["clicktype"] == kind:
                agg[(r["site"], r["campaignid"], r["adgroupid"], r["adid"], r["day"],
                     r["_sdc_report_datetime"])] += r["impressions"]
        imps[kind] = agg
    btop = {}
    for r in report:
        k = (r["site"], r["campaignid"])
        btop[k] = max(btop.get(k, r["_sdc_report_datetime"]), r["_sdc_report_datetime"])
    budgets = {(r["site"], r["campaignid"], r["budget"] / 1e6) for r in report
               if btop[(r["site"], r["campaignid"])] == r["_sdc_report_datetime"]}
    final = set()
    for site, camp, ag, ad, agn, cname, desc, state, day, _ts, c, m in items:
        def matches(kind):
            return [v for kk, v in imps[kind].items()
                    if kk[:5] == (site, camp, ag, ad, day)] or [None]
        bs = [b for (s, cc, b) in budgets if (s, cc) == (site, camp)] or [None]
        for h in matches("Headline"):
            for p in matches("Phone calls"):
                for b in bs:
                    final.add((site, camp, ag, ad, agn, cname, desc, state, day, c, m,
                               h if h is not None else p, b))
    out = defaultdict(lambda: [0, 0, 0])
    for site, camp, ag, ad, agn, cname, desc, state, day, c, m, imp, b in final:
        acc = out[(site, camp, ag, ad, day.date(), agn, cname, desc, state, b)]
        acc[0] += imp or 0
        acc[1] += c
        acc[2] += m
    return sorted((k + (v[0], v[1], v[2] / 1e6) for k, v in out.items()), key=repr)


@SETTINGS
@given(ads=ga_rows, report=report_rows)
def test_search_creatives_equal_brute_force(spark, mk, ads, report):
    from conftest import CAMPAIGN_REPORT, GOOGLE_AD
    cfg = [SiteConfig("S", google=True), SiteConfig("T", google=True)]
    ad_df = frame(spark, schemas.GOOGLE_ADS, GOOGLE_AD, *ads)
    rep_df = frame(spark, schemas.GOOGLE_CAMPAIGN_REPORT, CAMPAIGN_REPORT, *report)
    out = ppc.ppc_creatives(ad_df, rep_df, mk.bing_ads(), mk.bing_campaigns(), cfg)
    got = sorted(((r.site, r.campaign_id, r.adgroup_id, r.creative_id, r.date, r.adgroup,
                   r.campaign, r.description, r.creative_state, r.budget, r.impressions,
                   r.clicks, r.cost) for r in out.collect()), key=repr)
    assert got == brute_force_search_creatives(ads, report)


action_lists = st.one_of(st.none(), st.lists(st.tuples(
    st.sampled_from(["like", "link_click", "post_reaction", "other", None]),
    st.sampled_from([1, 2, None])), max_size=3))
ins_rows = st.lists(st.fixed_dictionaries({
    "site": st.sampled_from(["S"]),
    "campaign_id": st.integers(1, 2),
    "adset_id": st.integers(1, 2),
    "ad_id": st.integers(1, 2),
    "date_start": st.sampled_from([dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 6),
                                   dt.datetime(2024, 1, 2)]),
    "impressions": st.integers(0, 5),
    "clicks": st.integers(0, 2),
    "reach": st.integers(1, 2),
    "actions": action_lists,
}), min_size=1, max_size=8)
entity_rows = st.lists(st.fixed_dictionaries({
    "id": st.integers(1, 2),
    "effective_status": st.sampled_from(["ACTIVE", "PAUSED"]),
    "_sdc_received_at": st.sampled_from(LOADS),
}), min_size=0, max_size=4)
camp_versions = st.lists(st.fixed_dictionaries({
    "id": st.integers(1, 2),
    "account_id": st.sampled_from(["42", "99"]),
    "name": st.sampled_from(["Camp", "Camp renamed"]),
    "effective_status": st.sampled_from(["ACTIVE", "PAUSED"]),
    "_sdc_received_at": st.sampled_from(LOADS),
}), min_size=1, max_size=4)


def _statuses(rows):
    top = {}
    for r in rows:
        top[r["id"]] = max(top.get(r["id"], r["_sdc_received_at"]), r["_sdc_received_at"])
    out = defaultdict(set)
    for r in rows:
        if r["_sdc_received_at"] == top[r["id"]]:
            out[r["id"]].add(r["effective_status"])
    return out


def brute_force_social(ins, camps, sets, ads):
    names = {"42": "s.example"}
    base = set()
    for i in ins:
        for c in camps:
            for a in sets:
                if c["id"] == i["campaign_id"] and a["id"] == i["adset_id"]:
                    base.add((c["account_id"], c["id"], c["name"], i["adset_id"], i["ad_id"],
                              i["date_start"], names.get(c["account_id"]), i["impressions"],
                              i["clicks"], i["reach"]))
    stats = defaultdict(int)
    present = set()
    for i in ins:
        for t, v in (i["actions"] or []):
            k = (t, i["ad_id"], i["adset_id"], i["campaign_id"], i["date_start"])
            present.add(k)
            stats[k] += v or 0
    has_value = defaultdict(bool)
    for i in ins:
        for t, v in (i["actions"] or []):
            if v is not None:
                has_value[(t, i["ad_id"], i["adset_id"], i["campaign_id"], i["date_start"])] = True
    pivot = defaultdict(lambda: {"post_reaction": None, "link_click": None, "like": None})
    for k in present:
        t, ad, st_, camp, day = k
        row = pivot[(camp, st_, ad, day)]
        for kind in row:
            val = stats[k] if (t == kind and has_value[k]) else (0 if t != kind else None)
            if val is not None:
                row[kind] = (row[kind] or 0) + val
    ad_st, set_st, camp_st = _statuses(ads), _statuses(sets), _statuses(camps)
    out = defaultdict(lambda: [0, 0, None, None, None])
    for acct, camp, cname, adset, ad, day, aname, imp, clicks, _reach in base:
        matches = [v for (c, s, a, d), v in pivot.items()
                   if (c, s, a) == (camp, adset, ad) and d.date() == day.date()] or [None]
        for s_ad in ad_st.get(ad, {None}):
            for s_set in set_st.get(adset, {None}):
                for s_camp in camp_st.get(camp, {None}):
                    for m in matches:
                        acc = out[(day, aname, acct, camp, cname, adset, ad, s_camp, s_set, s_ad)]
                        acc[0] += imp
                        acc[1] += clicks
                        if m is not None:
                            for j, kind in ((2, "post_reaction"), (3, "link_click"), (4, "like")):
                                if m[kind] is not None:
                                    acc[j] = (acc[j] or 0) + m[kind]
    return sorted((k + tuple(v) for k, v in out.items()), key=repr)


@SETTINGS
@given(ins=ins_rows, camps=camp_versions, sets=entity_rows, ads=entity_rows)
def test_social_ads_equal_brute_force(spark, mk, ins, camps, sets, ads):
    from conftest import INSIGHT, SOCIAL_AD, SOCIAL_ADSET, SOCIAL_CAMPAIGN
    from adledger.plans import social
    cfg = [SiteConfig("S", facebook=True, social_account_id="42", account_name="s.example")]
    rows = [dict(r, actions=None if r["actions"] is None else
                 [{"value": {"action_type": t, "value": v}} for t, v in r["actions"]])
            for r in ins]
    out = social.social_ads(frame(spark, schemas.SOCIAL_INSIGHTS, INSIGHT, *rows),
                            frame(spark, schemas.SOCIAL_CAMPAIGNS, SOCIAL_CAMPAIGN, *camps),
                            frame(spark, schemas.SOCIAL_ADSETS, SOCIAL_ADSET, *sets),
                            frame(spark, schemas.SOCIAL_ADS, SOCIAL_AD, *ads), cfg)
    got = sorted(((r.date, r.account_name, r.account_id, r.campaign_id, r.campaign_name,
                   r.adgroup_id, r.ad_id, r.campaign_status, r.adgroup_status, r.ad_status,
                   r.impressions, r.clicks, r.post_reactions_ad, r.link_clicks_ad, r.likes_ad)
                  for r in out.collect()), key=repr)
    assert got == brute_force_social(ins, camps, sets, ads)
