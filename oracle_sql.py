"""Independent SQL oracle (DuckDB dialect) for every registered query.

The SQL follows the semantics of the original warehouse statements directly:
self-join snapshot picks, one scan per consumer, raw rows joined to raw
dimensions with their fan-out, sums at the end.  The Spark side computes the
same results with pre-aggregation and multiplicities, so agreement checks the
rewrite, not just the arithmetic.  The adapters from the seeded tables are
written out again here (FIXTURES.md section 2).

Money: integer micros are summed as BIGINT and divided by 1e6 once, as on the
Spark side, so doubles agree bit for bit.
"""

from __future__ import annotations

from adledger.config import TEST_SITES, SiteConfig, sites_where, sites_with
from adledger.functions import TRIM_PATTERN

AS_OF = "2001-08-01"


def _in(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")" if values else "(NULL)"


def _trim(expr: str) -> str:
    return f"regexp_replace({expr}, '{TRIM_PATTERN}', '', 'g')"


def _money(expr: str) -> str:
    return f"CAST(CAST({expr} AS BIGINT) AS DOUBLE) / 1e6"


def _ctes(config: list[SiteConfig], as_of: str) -> list[tuple[str, str]]:
    google = _in(sites_with(config, "google"))
    bing = _in(sites_with(config, "bing"))
    social = _in(sites_with(config, "facebook"))
    no_h3 = _in(sites_where(config, "has_headline3", False))
    three = _in(sites_where(config, "three_part_description", True))
    names = " ".join(f"WHEN '{c.social_account_id}' THEN '{c.account_name}'"
                     for c in config if c.social_account_id is not None)
    account_name = f"CASE c.account_id {names} ELSE NULL END" if names else "CAST(NULL AS VARCHAR)"
    patterns = [(c.site, c.adset_like) for c in config if c.adset_like]
    adset_cond = " AND ".join(
        f"(i.site <> '{s}' OR lower(i.adset_name) LIKE '{p}')" for s, p in patterns) or "TRUE"
    desc3 = _trim("coalesce(d1, '') || ' ' || coalesce(d2, '') || ' ' || coalesce(d3, '')")
    desc2 = _trim("coalesce(d1, '') || ' ' || coalesce(d2, '')")
    return [
        # ---------------- adapters (FIXTURES.md section 2) ----------------
        ("a_lines", """
            SELECT l.*, o.o_orderdate, p.p_name, p.p_brand, p.p_type, p.p_retailprice,
                   s.s_name, s.s_acctbal, n.n_regionkey, r.r_name
            FROM lineitem l
            JOIN orders o ON l.l_orderkey = o.o_orderkey
            JOIN part p ON l.l_partkey = p.p_partkey
            JOIN supplier s ON l.l_suppkey = s.s_suppkey
            JOIN nation n ON s.s_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey"""),
        ("a_cols", """
            SELECT r_name AS site, r_name AS account, CAST(n_regionkey AS BIGINT) AS customerid,
                   l_suppkey AS campaignid,
                   (CASE WHEN l_suppkey % 5 = 0 THEN 'Display ' ELSE 'Search ' END) || s_name AS campaign,
                   l_suppkey * 100 + l_partkey % 5 AS adgroupid, p_type AS adgroup,
                   CASE l_returnflag WHEN 'N' THEN 'Headline' WHEN 'R' THEN 'Phone calls'
                        ELSE 'Other' END AS clicktype,
                   CAST(l_linenumber AS BIGINT) AS clicks, CAST(l_quantity AS BIGINT) AS impressions,
                   CAST(round(l_extendedprice * 1e6) AS BIGINT) AS cost,
                   l_linestatus AS adgroupstate, l_linestatus AS campaignstate,
                   date_trunc('month', l_shipdate) AS day,
                   date_trunc('year', o_orderdate) AS _sdc_report_datetime,
                   l_partkey, p_name, p_brand, p_type, p_retailprice, l_linestatus, s_acctbal
            FROM a_lines"""),
        ("g_ads", """
            SELECT site, account, customerid, campaignid, campaign, adgroupid, adgroup,
                   l_partkey AS adid, clicktype, clicks, impressions, cost,
                   'https://example.com/p/' || CAST(l_partkey AS VARCHAR) AS finalurl,
                   p_name AS headline1, p_brand AS headline2, p_type AS expandedtextadheadline3,
                   p_name AS description, p_brand AS expandedtextaddescription2,
                   p_brand AS descriptionline1, p_type AS descriptionline2,
                   adgroupstate, campaignstate, l_linestatus AS adstate, day, _sdc_report_datetime
            FROM a_cols"""),
        ("g_kw", """
            SELECT site, account, customerid, campaignid, adgroupid, adgroup,
                   l_partkey AS keywordid, p_name AS keyword, clicktype, clicks, impressions, cost,
                   CAST(round(p_retailprice * 1e6) AS BIGINT) AS maxcpc, p_brand AS matchtype,
                   adgroupstate, campaignstate, l_linestatus AS keywordstate, day,
                   _sdc_report_datetime
            FROM a_cols"""),
        ("g_camp_report", """
            SELECT site, campaignid, campaign, campaignid AS budgetid,
                   FALSE AS hasrecommendedbudget, 'DAILY' AS budgetperiod,
                   CAST(round(s_acctbal * 1e6) AS BIGINT) AS budget, _sdc_report_datetime
            FROM a_cols"""),
        ("g_campaigns", """
            SELECT r.r_name AS site, s.s_suppkey AS id,
                   (CASE WHEN s.s_suppkey % 5 = 0 THEN 'Display ' ELSE 'Search ' END) || s.s_name AS name
            FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey"""),
        ("b_orders", """
            SELECT o.*, c.c_name, c.c_nationkey, c.c_mktsegment, r.r_name
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
            JOIN nation n ON c.c_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey"""),
        ("b_cols", """
            SELECT r_name AS site, 'acct' || CAST(c_nationkey AS VARCHAR) AS accountname,
                   CAST(c_nationkey AS BIGINT) AS accountid, o_custkey % 50 AS campaignid,
                   'Campaign ' || CAST(o_custkey % 50 AS VARCHAR) AS campaignname,
                   o_custkey % 400 AS adgroupid,
                   'Group ' || CAST(o_custkey % 400 AS VARCHAR) AS adgroupname,
                   o_custkey % 1000 AS item_id, o_orderkey % 1000 AS impressions,
                   o_orderkey % 50 AS clicks, o_totalprice AS spend,
                   CASE WHEN o_orderstatus = 'F' THEN 'Active' ELSE 'Paused' END AS status,
                   o_orderdate AS timeperiod,
                   CAST(CAST(date_trunc('month', o_orderdate) AS DATE)
                        + CAST(o_orderkey % 3 AS INTEGER) AS TIMESTAMP) AS _sdc_report_datetime,
                   o_custkey, c_mktsegment, o_orderpriority, c_name, o_orderstatus
            FROM b_orders"""),
        ("b_ads", """
            SELECT site, accountname, accountid, campaignid, campaignname, adgroupid, adgroupname,
                   item_id AS adid, impressions, clicks, spend,
                   'https://example.com/c/' || CAST(item_id AS VARCHAR) AS finalurl,
                   c_mktsegment AS titlepart1, o_orderpriority AS titlepart2,
                   c_name AS addescription, status AS adgroupstatus, status AS campaignstatus,
                   status AS adstatus, timeperiod, _sdc_report_datetime
            FROM b_cols"""),
        ("b_kw", """
            SELECT site, accountname, accountid, campaignid, campaignname, adgroupid, adgroupname,
                   item_id AS keywordid, c_mktsegment AS keyword, impressions, clicks, spend,
                   CASE o_orderstatus WHEN 'O' THEN '' WHEN 'F' THEN 'Exact'
                        WHEN 'P' THEN 'Phrase' END AS bidmatchtype,
                   status AS adgroupstatus, status AS campaignstatus, status AS keywordstatus,
                   timeperiod, _sdc_report_datetime
            FROM b_cols"""),
        ("b_campaigns", """
            SELECT DISTINCT site, campaignid AS id, CAST(campaignid AS DOUBLE) * 1.5 AS dailybudget
            FROM b_cols"""),
        ("c_events", """
            SELECT user_id, CAST(ts AS DATE) AS d, event_type, value,
                   CASE event_type WHEN 'click' THEN 'link_click' WHEN 'view' THEN 'post_reaction'
                        WHEN 'signup' THEN 'like' ELSE 'other' END AS action_type
            FROM events"""),
        ("c_insights", """
            SELECT CAST(user_id % 5 AS VARCHAR) AS site, user_id % 10 AS campaign_id,
                   user_id % 20 AS adset_id,
                   (CASE WHEN (user_id % 20) % 2 = 0 THEN 'Hernia Mesh ' ELSE 'General ' END)
                     || CAST(user_id % 20 AS VARCHAR) AS adset_name,
                   user_id AS ad_id, 'Ad ' || CAST(user_id AS VARCHAR) AS ad_name,
                   CAST(d AS TIMESTAMP) AS date_start, count(*) AS impressions,
                   count(*) FILTER (WHERE event_type = 'click') AS clicks,
                   CAST(sum(CAST(round(value * 1e6) AS BIGINT)) AS BIGINT) / 1e6 AS spend,
                   count(*) AS reach, 1.0::DOUBLE AS frequency,
                   count(*) FILTER (WHERE event_type = 'click') AS inline_link_clicks,
                   CAST(d AS TIMESTAMP) AS _sdc_received_at
            FROM c_events GROUP BY user_id, d"""),
        ("c_action_entries", """
            SELECT CAST(user_id % 5 AS VARCHAR) AS site, action_type, user_id AS ad_id,
                   user_id % 20 AS adset_id, user_id % 10 AS campaign_id,
                   CAST(d AS TIMESTAMP) AS date_start, count(*) AS value
            FROM c_events WHERE value > 50
            GROUP BY user_id, d, action_type"""),
        ("c_ads", """
            SELECT CAST(user_id % 5 AS VARCHAR) AS site, user_id AS id,
                   CASE WHEN max(value) > 100 THEN 'PAUSED' ELSE 'ACTIVE' END AS effective_status,
                   CAST(d AS TIMESTAMP) AS _sdc_received_at
            FROM c_events GROUP BY user_id, d"""),
        ("c_adsets", """
            SELECT CAST((user_id % 20) % 5 AS VARCHAR) AS site, user_id % 20 AS id,
                   CASE WHEN max(value) > 100 THEN 'PAUSED' ELSE 'ACTIVE' END AS effective_status,
                   CAST(d AS TIMESTAMP) AS _sdc_received_at
            FROM c_events GROUP BY user_id % 20, d"""),
        ("c_campaigns", """
            SELECT CAST((user_id % 10) % 5 AS VARCHAR) AS site, user_id % 10 AS id,
                   CAST((user_id % 10) % 5 AS VARCHAR) AS account_id,
                   'Campaign ' || CAST(user_id % 10 AS VARCHAR) AS name,
                   CASE WHEN max(value) > 100 THEN 'PAUSED' ELSE 'ACTIVE' END AS effective_status,
                   CAST(d AS TIMESTAMP) AS _sdc_received_at
            FROM c_events GROUP BY user_id % 10, d"""),
        # ---------------- search network creatives ----------------
        ("ga", f"""
            SELECT site, account, customerid, campaignid, campaign, adgroupid, adgroup, adid,
                   clicktype, clicks, impressions, cost, finalurl, headline1, headline2,
                   CASE WHEN site IN {no_h3} THEN NULL ELSE expandedtextadheadline3 END AS h3,
                   description AS d1,
                   CASE WHEN site IN {three} THEN descriptionline1
                        ELSE expandedtextaddescription2 END AS d2,
                   CASE WHEN site IN {three} THEN descriptionline2 END AS d3,
                   site IN {three} AS three_part,
                   adgroupstate, campaignstate, adstate, day, _sdc_report_datetime AS ts
            FROM g_ads WHERE site IN {google}"""),
        ("ga_max", """
            SELECT site, adgroup, day, max(ts) AS ts FROM ga GROUP BY site, adgroup, day"""),
        ("ga_latest", """
            SELECT b.* FROM ga_max a JOIN ga b
              ON a.site = b.site AND a.adgroup = b.adgroup AND a.day = b.day AND a.ts = b.ts"""),
        ("ga_ad", f"""
            SELECT DISTINCT site, account, customerid,
                   CASE WHEN account IS NOT NULL THEN 'AdWords' END AS platform,
                   campaignid, adgroupid, adid, adgroup, campaign, clicks, cost_micros, finalurl,
                   headline1, headline2, h3 AS expandedtextadheadline3,
                   CASE WHEN three_part THEN {desc3} ELSE {desc2} END AS description,
                   adgroupstate, campaignstate, adstate, day, ts
            FROM (SELECT site, account, customerid, campaignid, adgroupid, adid, adgroup, campaign,
                         finalurl, headline1, headline2, h3, d1, d2, d3, three_part,
                         adgroupstate, campaignstate, adstate, day, ts,
                         CAST(sum(clicks) AS BIGINT) AS clicks,
                         CAST(sum(cost) AS BIGINT) AS cost_micros
                  FROM ga_latest WHERE NOT (lower(campaign) LIKE '%display%')
                  GROUP BY site, account, customerid, campaignid, adgroupid, adid, adgroup,
                           campaign, finalurl, headline1, headline2, h3, d1, d2, d3, three_part,
                           adgroupstate, campaignstate, adstate, day, ts)"""),
        ("ga_ad_all", f"""
            SELECT DISTINCT site, account, customerid,
                   CASE WHEN account IS NOT NULL THEN 'AdWords' END AS platform,
                   campaignid, adgroupid, adid, adgroup, CAST(NULL AS VARCHAR) AS campaign,
                   clicks, cost_micros, finalurl, headline1, headline2,
                   h3 AS expandedtextadheadline3,
                   CASE WHEN three_part THEN {desc3} ELSE {desc2} END AS description,
                   adgroupstate, campaignstate, adstate, day, ts
            FROM (SELECT site, account, customerid, campaignid, adgroupid, adid, adgroup,
                         finalurl, headline1, headline2, h3, d1, d2, d3, three_part,
                         adgroupstate, campaignstate, adstate, day, ts,
                         CAST(sum(clicks) AS BIGINT) AS clicks,
                         CAST(sum(cost) AS BIGINT) AS cost_micros
                  FROM ga_latest
                  GROUP BY site, account, customerid, campaignid, adgroupid, adid, adgroup,
                           finalurl, headline1, headline2, h3, d1, d2, d3, three_part,
                           adgroupstate, campaignstate, adstate, day, ts)"""),
        ("ga_head", """
            SELECT site, customerid, campaignid, adgroupid, adid, day, ts,
                   CAST(sum(impressions) AS BIGINT) AS impressions
            FROM ga_latest WHERE clicktype = 'Headline'
            GROUP BY site, customerid, campaignid, adgroupid, adid, day, ts"""),
        ("ga_phone", """
            SELECT site, customerid, campaignid, adgroupid, adid, day, ts,
                   CAST(sum(impressions) AS BIGINT) AS impressions
            FROM ga_latest WHERE clicktype = 'Phone calls'
            GROUP BY site, customerid, campaignid, adgroupid, adid, day, ts"""),
        ("gc", f"""SELECT * FROM g_camp_report WHERE site IN {google}"""),
        ("gc_max", """
            SELECT site, campaignid, max(_sdc_report_datetime) AS ts FROM gc
            GROUP BY site, campaignid"""),
        ("g_budget", """
            SELECT DISTINCT a.site, a.campaignid, b.campaign, b.budgetid,
                   b.hasrecommendedbudget AS has_recommended_budget,
                   b.budgetperiod AS budget_period, CAST(b.budget AS DOUBLE) / 1e6 AS budget
            FROM gc_max a JOIN gc b ON a.site = b.site AND a.campaignid = b.campaignid
                                   AND a.ts = b._sdc_report_datetime"""),
        ("ga_final", """
            SELECT DISTINCT a.site, a.account, a.customerid, a.platform, a.campaignid, a.adgroupid,
                   a.adid, a.adgroup, a.campaign, a.clicks, a.cost_micros, a.finalurl, a.headline1,
                   a.headline2, a.expandedtextadheadline3, a.description, a.adgroupstate, a.campaignstate, a.adstate,
                   a.day, COALESCE(h.impressions, p.impressions) AS impressions, d.budget
            FROM ga_ad a
            LEFT JOIN ga_head h ON a.site = h.site AND a.campaignid = h.campaignid
                 AND a.adgroupid = h.adgroupid AND a.adid = h.adid AND a.day = h.day
            LEFT JOIN ga_phone p ON a.site = p.site AND a.campaignid = p.campaignid
                 AND a.adgroupid = p.adgroupid AND a.adid = p.adid AND a.day = p.day
            LEFT JOIN g_budget d ON a.site = d.site AND a.campaignid = d.campaignid"""),
        ("ga_final_all", """
            SELECT DISTINCT a.site, a.account, a.customerid, a.platform, a.campaignid, a.adgroupid,
                   a.adid, a.adgroup, a.campaign, a.clicks, a.cost_micros, a.finalurl, a.headline1,
                   a.headline2, a.expandedtextadheadline3, a.description, a.adgroupstate, a.campaignstate, a.adstate,
                   a.day, COALESCE(h.impressions, p.impressions) AS impressions, d.budget
            FROM ga_ad_all a
            LEFT JOIN ga_head h ON a.site = h.site AND a.campaignid = h.campaignid
                 AND a.adgroupid = h.adgroupid AND a.adid = h.adid AND a.day = h.day
            LEFT JOIN ga_phone p ON a.site = p.site AND a.campaignid = p.campaignid
                 AND a.adgroupid = p.adgroupid AND a.adid = p.adid AND a.day = p.day
            LEFT JOIN g_budget d ON a.site = d.site AND a.campaignid = d.campaignid"""),
        ("ga_rows", _google_creative_rows("ga_final")),
        ("ga_rows_all", _google_creative_rows("ga_final_all")),
        # ---------------- search partner creatives ----------------
        ("ba", f"""SELECT * FROM b_ads WHERE site IN {bing}"""),
        ("bc", f"""SELECT * FROM b_campaigns WHERE site IN {bing}"""),
        ("ba_max", """
            SELECT site, timeperiod, max(_sdc_report_datetime) AS ts FROM ba
            GROUP BY site, timeperiod"""),
        ("ba_latest", """
            SELECT b.* FROM ba_max a JOIN ba b
              ON a.site = b.site AND a.ts = b._sdc_report_datetime AND a.timeperiod = b.timeperiod"""),
        ("ba_budget", """
            SELECT b.*, c.dailybudget AS budget FROM ba_latest b
            JOIN bc c ON b.site = c.site AND b.campaignid = c.id"""),
        ("ba_rows", """
            SELECT site, accountname AS account, accountid AS account_id,
                   CASE WHEN accountid IS NOT NULL THEN 'Bing' END AS platform,
                   campaignid AS campaign_id, adgroupid AS adgroup_id, adid AS creative_id,
                   adgroupname AS adgroup, campaignname AS campaign, impressions, clicks,
                   CAST(round(spend * 1e6) AS BIGINT) AS cost_micros, finalurl AS url,
                   titlepart1 AS headline1, titlepart2 AS headline2,
                   CAST(NULL AS VARCHAR) AS headline3, addescription AS description,
                   adgroupstatus AS adgroup_state, campaignstatus AS campaign_state,
                   adstatus AS creative_state, timeperiod AS date, budget
            FROM ba_budget"""),
        # ---------------- search network keywords ----------------
        ("gk", f"""SELECT * FROM g_kw WHERE site IN {google}"""),
        ("gk_max", """
            SELECT site, adgroup, day, max(_sdc_report_datetime) AS ts FROM gk
            GROUP BY site, adgroup, day"""),
        ("gk_latest", """
            SELECT b.* FROM gk_max a JOIN gk b ON a.site = b.site AND a.adgroup = b.adgroup
              AND a.day = b.day AND a.ts = b._sdc_report_datetime"""),
        ("gcamp", f"""SELECT * FROM g_campaigns WHERE site IN {google}"""),
        ("gk_dim", """
            SELECT b.*, c.name AS campaign FROM gk_latest b
            JOIN gcamp c ON b.site = c.site AND b.campaignid = c.id"""),
        ("gk_kw", _keyword_level("NOT (lower(campaign) LIKE '%display%')")),
        ("gk_kw_display", _keyword_level("lower(campaign) LIKE '%display%'")),
        ("gk_head", """
            SELECT site, customerid, campaignid, adgroupid, keywordid, day,
                   _sdc_report_datetime AS ts, CAST(sum(impressions) AS BIGINT) AS impressions
            FROM gk_latest WHERE clicktype = 'Headline'
            GROUP BY site, customerid, campaignid, adgroupid, keywordid, day, _sdc_report_datetime"""),
        ("gk_phone", """
            SELECT site, customerid, campaignid, adgroupid, keywordid, day,
                   _sdc_report_datetime AS ts, CAST(sum(impressions) AS BIGINT) AS impressions
            FROM gk_latest WHERE clicktype = 'Phone calls'
            GROUP BY site, customerid, campaignid, adgroupid, keywordid, day, _sdc_report_datetime"""),
        ("gk_final", _keyword_final("gk_kw")),
        ("gk_final_display", _keyword_final("gk_kw_display")),
        ("gk_rows", _google_keyword_rows("gk_final")),
        ("gk_rows_display", _google_keyword_rows("gk_final_display")),
        # ---------------- search partner keywords ----------------
        ("bk", f"""SELECT * FROM b_kw WHERE site IN {bing}"""),
        ("bk_window", f"""
            SELECT * FROM bk WHERE CAST(timeperiod AS DATE)
              BETWEEN DATE '{as_of}' - 30 AND DATE '{as_of}'"""),
        ("bk_max", """
            SELECT site, timeperiod, max(_sdc_report_datetime) AS ts FROM bk_window
            GROUP BY site, timeperiod"""),
        ("bk_kw", """
            SELECT b.*, c.dailybudget AS budget FROM bk_max a
            JOIN bk b ON a.site = b.site AND a.ts = b._sdc_report_datetime
                     AND a.timeperiod = b.timeperiod
            JOIN bc c ON b.site = c.site AND b.campaignid = c.id"""),
        ("bk_last_day", """
            SELECT site, campaignid, adgroupid, keywordid, max(timeperiod) AS timeperiod
            FROM bk WHERE bidmatchtype != ''
            GROUP BY site, campaignid, adgroupid, keywordid"""),
        ("bk_mt", """
            SELECT DISTINCT a.site, a.campaignid, a.adgroupid, a.keywordid, a.bidmatchtype
            FROM bk a JOIN bk_last_day c ON a.site = c.site AND a.campaignid = c.campaignid
              AND a.adgroupid = c.adgroupid AND a.keywordid = c.keywordid
              AND a.timeperiod = c.timeperiod
            WHERE a.bidmatchtype != ''"""),
        ("bk_final", """
            SELECT a.*, m.bidmatchtype AS match_type FROM bk_kw a
            LEFT JOIN bk_mt m ON a.site = m.site AND a.keywordid = m.keywordid"""),
        ("bk_rows", """
            SELECT site, accountname AS account, accountid AS account_id,
                   CASE WHEN accountid IS NOT NULL THEN 'Bing' END AS platform,
                   campaignid AS campaign_id, adgroupid AS adgroup_id, keywordid AS keyword_id,
                   adgroupname AS adgroup, campaignname AS campaign, keyword, impressions, clicks,
                   CAST(round(spend * 1e6) AS BIGINT) AS cost_micros,
                   adgroupstatus AS adgroup_state, campaignstatus AS campaign_state,
                   keywordstatus AS keyword_state, match_type, timeperiod AS date,
                   CAST(0 AS BIGINT) AS max_cpc_micros, budget
            FROM bk_final"""),
        # ---------------- social ----------------
        ("si", f"""SELECT * FROM c_insights WHERE site IN {social}"""),
        ("s_camps", f"""SELECT * FROM c_campaigns WHERE site IN {social}"""),
        ("s_adsets", f"""SELECT * FROM c_adsets WHERE site IN {social}"""),
        ("s_ads", f"""SELECT * FROM c_ads WHERE site IN {social}"""),
        ("si_filtered", f"""SELECT * FROM si i WHERE {adset_cond}"""),
        ("s_base", f"""
            SELECT DISTINCT i.site, c.account_id, c.id AS campaign_id, c.name AS campaign_name,
                   i.adset_id AS adgroup_id, i.adset_name AS adgroup_name, i.ad_id, i.ad_name,
                   i.date_start AS date, {account_name} AS account_name,
                   i.impressions, i.clicks, CAST(round(i.spend * 1e6) AS BIGINT) AS cost_micros,
                   i.reach, i.frequency, i.inline_link_clicks AS link_clicks
            FROM s_camps c
            JOIN si i ON c.site = i.site AND c.id = i.campaign_id
            JOIN s_adsets a ON i.site = a.site AND i.adset_id = a.id
            WHERE {adset_cond}"""),
        ("s_ad_status", _status("s_ads", "ad_status")),
        ("s_adset_status", _status("s_adsets", "adgroup_status")),
        ("s_campaign_status", _status("s_camps", "campaign_status")),
        ("s_stats", f"""
            SELECT site, action_type, ad_id, adset_id, campaign_id, date_start,
                   CAST(sum(value) AS BIGINT) AS value
            FROM c_action_entries WHERE site IN {social}
            GROUP BY site, action_type, ad_id, adset_id, campaign_id, date_start"""),
        ("s_ad_stats", _pivot(["campaign_id", "adset_id", "ad_id", "date_start"], "ad")),
        ("s_with_status", """
            SELECT a.*, d.campaign_status, c.adgroup_status, b.ad_status
            FROM s_base a
            LEFT JOIN s_ad_status b ON a.site = b.site AND a.ad_id = b.id
            LEFT JOIN s_adset_status c ON a.site = c.site AND a.adgroup_id = c.id
            LEFT JOIN s_campaign_status d ON a.site = d.site AND a.campaign_id = d.id"""),
        ("s_daily", f"""
            SELECT a.site, a.date, a.account_name, a.account_id, a.campaign_id, a.campaign_name,
                   a.adgroup_id, a.adgroup_name, a.ad_id, a.ad_name, a.campaign_status,
                   a.adgroup_status, a.ad_status,
                   CAST(sum(a.impressions) AS BIGINT) AS impressions,
                   CAST(sum(a.clicks) AS BIGINT) AS clicks, {_money('sum(a.cost_micros)')} AS cost,
                   CAST(sum(a.link_clicks) AS BIGINT) AS link_clicks,
                   CAST(sum(e.post_reactions_ad) AS BIGINT) AS post_reactions_ad,
                   CAST(sum(e.link_clicks_ad) AS BIGINT) AS link_clicks_ad,
                   CAST(sum(e.likes_ad) AS BIGINT) AS likes_ad
            FROM s_with_status a
            LEFT JOIN s_ad_stats e ON a.site = e.site AND a.ad_id = e.ad_id
              AND a.adgroup_id = e.adset_id AND a.campaign_id = e.campaign_id
              AND CAST(a.date AS DATE) = CAST(e.date_start AS DATE)
            GROUP BY a.site, a.date, a.account_name, a.account_id, a.campaign_id, a.campaign_name,
                     a.adgroup_id, a.adgroup_name, a.ad_id, a.ad_name, a.campaign_status,
                     a.adgroup_status, a.ad_status"""),
        # ---------------- daily datasets ----------------
        ("creatives_daily", _creatives_daily("SELECT * FROM ga_rows UNION ALL SELECT * FROM ba_rows")),
        ("display_creatives_daily", _creatives_daily("SELECT * FROM ga_rows_all")),
        ("keywords_daily", _keywords_daily("SELECT * FROM gk_rows UNION ALL SELECT * FROM bk_rows")),
        ("display_keywords_daily", _keywords_daily("SELECT * FROM gk_rows_display")),
    ]


def _whole_rows(rows: str) -> str:
    return f"""
            SELECT * EXCLUDE (date, impressions, clicks, cost_micros), CAST(date AS DATE) AS date,
                   CAST(sum(impressions) AS BIGINT) AS impressions,
                   CAST(sum(clicks) AS BIGINT) AS clicks,
                   CAST(sum(cost_micros) AS BIGINT) AS cost_micros
            FROM ({rows}) GROUP BY ALL"""


def _google_creative_rows(src: str) -> str:
    return f"""
            SELECT site, account, customerid AS account_id, platform, campaignid AS campaign_id,
                   adgroupid AS adgroup_id, adid AS creative_id, adgroup, campaign,
                   COALESCE(impressions, 0) AS impressions, clicks, cost_micros, finalurl AS url,
                   headline1, headline2, expandedtextadheadline3 AS headline3, description,
                   adgroupstate AS adgroup_state, campaignstate AS campaign_state,
                   adstate AS creative_state, day AS date, budget
            FROM {src}"""


def _keyword_level(cond: str) -> str:
    return f"""
            SELECT site, account, customerid,
                   CASE WHEN account IS NOT NULL THEN 'AdWords' END AS platform,
                   campaignid, adgroupid, keywordid, adgroup, campaign, keyword,
                   CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(cost) AS BIGINT) AS cost_micros,
                   adgroupstate, campaignstate, keywordstate, matchtype, day,
                   _sdc_report_datetime AS ts, max(maxcpc) AS maxcpc_micros
            FROM gk_dim WHERE {cond}
            GROUP BY site, account, customerid, campaignid, adgroupid, keywordid, adgroup, campaign,
                     keyword, adgroupstate, campaignstate, keywordstate, matchtype, day,
                     _sdc_report_datetime"""


def _keyword_final(src: str) -> str:
    return f"""
            SELECT DISTINCT a.site, a.account, a.customerid, a.platform, a.campaignid, a.adgroupid,
                   a.keywordid, a.adgroup, a.campaign, a.keyword, a.clicks, a.cost_micros,
                   a.adgroupstate, a.campaignstate, a.keywordstate, a.matchtype, a.day,
                   COALESCE(a.maxcpc_micros, 0) AS max_cpc_micros,
                   COALESCE(h.impressions, p.impressions) AS impressions, d.budget
            FROM {src} a
            LEFT JOIN gk_head h ON a.site = h.site AND a.campaignid = h.campaignid
                 AND a.adgroupid = h.adgroupid AND a.keywordid = h.keywordid AND a.day = h.day
            LEFT JOIN gk_phone p ON a.site = p.site AND a.campaignid = p.campaignid
                 AND a.adgroupid = p.adgroupid AND a.keywordid = p.keywordid AND a.day = p.day
            LEFT JOIN g_budget d ON a.site = d.site AND a.campaignid = d.campaignid"""


def _google_keyword_rows(src: str) -> str:
    return f"""
            SELECT site, account, customerid AS account_id, platform, campaignid AS campaign_id,
                   adgroupid AS adgroup_id, keywordid AS keyword_id, adgroup, campaign, keyword,
                   COALESCE(impressions, 0) AS impressions, clicks, cost_micros,
                   adgroupstate AS adgroup_state, campaignstate AS campaign_state,
                   keywordstate AS keyword_state, matchtype AS match_type, day AS date,
                   max_cpc_micros, budget
            FROM {src}"""


def _status(src: str, alias: str) -> str:
    return f"""
            SELECT DISTINCT a.site, a.id, b.effective_status AS {alias}
            FROM (SELECT site, id, max(_sdc_received_at) AS ts FROM {src} GROUP BY site, id) a
            JOIN {src} b ON a.site = b.site AND a.id = b.id AND a.ts = b._sdc_received_at"""


def _pivot(keys: list[str], suffix: str) -> str:
    k = ", ".join(keys)
    return f"""
            SELECT site, {k},
                   CAST(sum(CASE WHEN action_type = 'post_reaction' THEN value ELSE 0 END) AS BIGINT)
                     AS post_reactions_{suffix},
                   CAST(sum(CASE WHEN action_type = 'link_click' THEN value ELSE 0 END) AS BIGINT)
                     AS link_clicks_{suffix},
                   CAST(sum(CASE WHEN action_type = 'like' THEN value ELSE 0 END) AS BIGINT)
                     AS likes_{suffix}
            FROM s_stats GROUP BY site, {k}"""


CREATIVE_KEYS = ("account_id, campaign_id, adgroup_id, creative_id, date, platform, account, "
                 "adgroup, campaign, url, headline1, headline2, headline3, description, "
                 "adgroup_state, campaign_state, creative_state, budget")
KEYWORD_KEYS = ("account_id, campaign_id, adgroup_id, keyword_id, date, platform, account, "
                "adgroup, campaign, keyword, adgroup_state, campaign_state, keyword_state, "
                "match_type, budget")


def _creatives_daily(src: str) -> str:
    return f"""
            SELECT site, account_id, campaign_id, adgroup_id, creative_id, date, platform,
                   account, adgroup, campaign, CAST(sum(impressions) AS BIGINT) AS impressions,
                   CAST(sum(clicks) AS BIGINT) AS clicks, {_money('sum(cost_micros)')} AS cost,
                   url, headline1, headline2, headline3, description, adgroup_state,
                   campaign_state, creative_state, budget
            FROM (SELECT * REPLACE (CAST(date AS DATE) AS date) FROM ({src}))
            GROUP BY site, {CREATIVE_KEYS}"""


def _keywords_daily(src: str) -> str:
    return f"""
            SELECT site, account_id, campaign_id, adgroup_id, keyword_id, date, platform, account,
                   adgroup, campaign, keyword, CAST(sum(impressions) AS BIGINT) AS impressions,
                   CAST(sum(clicks) AS BIGINT) AS clicks, {_money('sum(cost_micros)')} AS cost,
                   adgroup_state, campaign_state, keyword_state, match_type,
                   CAST(max(max_cpc_micros) AS DOUBLE) / 1e6 AS max_cpc, budget
            FROM (SELECT * REPLACE (CAST(date AS DATE) AS date) FROM ({src}))
            GROUP BY site, {KEYWORD_KEYS}"""


def _with(body: str, config: list[SiteConfig], as_of: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in _ctes(config, as_of))
    return f"WITH {ctes}\n{body}"


CREATIVE_OUT = ("account_id, campaign_id, adgroup_id, creative_id, date, platform, account, "
                "adgroup, campaign, impressions, clicks, cost, url, headline1, headline2, "
                "headline3, description, adgroup_state, campaign_state, creative_state, budget")
KEYWORD_OUT = ("account_id, campaign_id, adgroup_id, keyword_id, date, platform, account, "
               "adgroup, campaign, keyword, impressions, clicks, cost, adgroup_state, "
               "campaign_state, keyword_state, match_type, max_cpc, budget")
SOCIAL_KEYS = ("date, account_name, account_id, campaign_id, campaign_name, adgroup_id, "
               "adgroup_name, ad_id, ad_name, campaign_status, adgroup_status, ad_status")


def _view_creatives(src: str) -> str:
    return f"""
        SELECT account_id, campaign_id, adgroup_id, creative_id, CAST(date AS DATE) AS date,
               platform, account, adgroup, campaign, CAST(sum(impressions) AS BIGINT) AS impressions,
               CAST(sum(clicks) AS BIGINT) AS clicks, sum(cost) AS cost, url, headline1, headline2,
               CAST(headline3 AS VARCHAR) AS headline3, description, adgroup_state, campaign_state,
               creative_state, budget
        FROM {src} GROUP BY site, {CREATIVE_KEYS}"""


def _view_keywords(src: str) -> str:
    return f"""
        SELECT account_id, campaign_id, adgroup_id, keyword_id, CAST(date AS DATE) AS date,
               platform, account, adgroup, campaign, keyword,
               CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
               sum(cost) AS cost, adgroup_state, campaign_state, keyword_state, match_type,
               max(max_cpc) AS max_cpc, budget
        FROM {src} GROUP BY site, {KEYWORD_KEYS}"""


def oracle_queries(config: list[SiteConfig] = TEST_SITES, as_of: str = AS_OF) -> dict[str, str]:
    q = {
        # --- adapter A: search network ---
        "scan_ad_report": "SELECT * FROM g_ads WHERE site IN " + _in(sites_with(config, "google")),
        "scan_site_sources": "SELECT * REPLACE (CASE WHEN site NOT IN " + _in(sites_where(config, "has_headline3", False))
            + " THEN expandedtextadheadline3 END AS expandedtextadheadline3) FROM g_ads WHERE site IN "
            + _in(sites_with(config, "google")),
        "site_network_filter": """
            SELECT site, campaignid, adgroupid, adid, timeperiod, _sdc_report_datetime,
                   impressions, clicks FROM ba""",
        "normalize_google_ads": "SELECT * FROM ga_rows",
        "normalize_google_keywords": "SELECT * FROM gk_rows",
        "platform_tag": """
            SELECT DISTINCT site, account_id, platform FROM
              (SELECT site, account_id, platform FROM ga_rows
               UNION ALL SELECT site, account_id, platform FROM ba_rows)""",
        "display_exclude": "SELECT DISTINCT site, campaignid, campaign FROM ga_ad",
        "display_only": "SELECT DISTINCT site, campaignid, campaign FROM gk_kw_display",
        "clicktype_impressions": """
            SELECT site, 'Headline' AS click_type, customerid, campaignid, adgroupid, adid, day,
                   ts AS _sdc_report_datetime, impressions FROM ga_head
            UNION ALL
            SELECT site, 'Phone calls' AS click_type, customerid, campaignid, adgroupid, adid, day,
                   ts AS _sdc_report_datetime, impressions FROM ga_phone""",
        **dict.fromkeys(("latest_snapshot_adgroup_day", "snapshot_kept", "snapshot_since"), """
            SELECT site, adgroup, day, ts AS _sdc_report_datetime, campaignid, adgroupid, adid,
                   clicktype, clicks, impressions, cost FROM ga_latest"""),
        "ad_clicks_cost": "SELECT * RENAME (ts AS _sdc_report_datetime) FROM ga_ad",
        "keyword_clicks_cost_cpc": "SELECT * RENAME (ts AS _sdc_report_datetime) FROM gk_kw",
        "impressions_attach": "SELECT * FROM ga_final",
        "ad_description": """
            SELECT DISTINCT site, d1 AS description_part1, d2 AS description_part2,
                   d3 AS description_part3, description FROM
              (SELECT site, d1, d2, d3, CASE WHEN three_part THEN """
            + _trim("coalesce(d1, '') || ' ' || coalesce(d2, '') || ' ' || coalesce(d3, '')")
            + " ELSE " + _trim("coalesce(d1, '') || ' ' || coalesce(d2, '')")
            + " END AS description FROM ga)",
        "micros_to_units": f"""
            SELECT site, campaignid, CAST(sum(cost) AS BIGINT) AS cost_micros,
                   {_money('sum(cost)')} AS cost FROM ga GROUP BY site, campaignid""",
        "group_by_ordinal": _creatives_daily("SELECT * FROM ga_rows"),
        "distinct_hidden_keys": "SELECT * RENAME (ts AS _sdc_report_datetime) FROM ga_ad_all",
        "ppc_google_creatives_daily": _creatives_daily("SELECT * FROM ga_rows"),
        # --- adapter A-camp ---
        "latest_snapshot_campaign": """
            SELECT b.site, b.campaignid, b.campaign, b.budget, b._sdc_report_datetime
            FROM gc_max a JOIN gc b ON a.site = b.site AND a.campaignid = b.campaignid
                                   AND a.ts = b._sdc_report_datetime""",
        "campaign_budget": "SELECT * FROM g_budget",
        "budget_attach": """
            SELECT a.site, a.campaignid, a.adgroupid, a.adid, a.day, a.clicks, d.budgetid,
                   d.budget_period, d.budget
            FROM ga_ad a LEFT JOIN g_budget d ON a.site = d.site AND a.campaignid = d.campaignid""",
        "campaign_dimension_join": """
            SELECT site, campaignid, campaign, keywordid, day,
                   CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(cost) AS BIGINT) AS cost_micros,
                   max(maxcpc) AS maxcpc_micros
            FROM gk_dim GROUP BY site, campaignid, campaign, keywordid, day""",
        # --- adapter B: search partner ---
        "normalize_bing_ads": _whole_rows("SELECT * FROM ba_rows"),
        "normalize_bing_keywords": _whole_rows("SELECT * FROM bk_rows"),
        "rolling_31_days": """
            SELECT site, campaignid, adgroupid, keywordid, timeperiod, _sdc_report_datetime,
                   bidmatchtype FROM bk_window""",
        "latest_snapshot_day": """
            SELECT site, timeperiod, _sdc_report_datetime, campaignid, adid, impressions, clicks
            FROM ba_latest""",
        "bing_daily_budget": """
            SELECT site, campaignid, timeperiod, budget,
                   CAST(sum(impressions) AS BIGINT) AS impressions,
                   CAST(sum(clicks) AS BIGINT) AS clicks,
                   CAST(sum(CAST(round(spend * 1e6) AS BIGINT)) AS BIGINT) AS cost_micros
            FROM ba_budget GROUP BY site, campaignid, timeperiod, budget""",
        "latest_match_type": "SELECT * FROM bk_mt",
        "match_type_attach": """
            SELECT site, keywordid, timeperiod, match_type,
                   CAST(sum(impressions) AS BIGINT) AS impressions,
                   CAST(sum(clicks) AS BIGINT) AS clicks,
                   CAST(sum(CAST(round(spend * 1e6) AS BIGINT)) AS BIGINT) AS cost_micros
            FROM bk_final GROUP BY site, keywordid, timeperiod, match_type""",
        # --- A + B ---
        "union_networks": _whole_rows(
            "SELECT * FROM (SELECT * FROM gk_rows UNION ALL BY NAME SELECT * FROM bk_rows)"),
        "ppc_creatives_daily": "SELECT * FROM creatives_daily",
        "ppc_keywords_daily": "SELECT * FROM keywords_daily",
        "display_creatives_daily": "SELECT * FROM display_creatives_daily",
        "display_keywords_daily": "SELECT * FROM display_keywords_daily",
        # --- adapter C: social ---
        "social_base": "SELECT * FROM s_base",
        "adset_pattern_filter": """
            SELECT site, campaign_id, adset_id, adset_name, ad_id, date_start FROM si_filtered""",
        "account_name_map": "SELECT DISTINCT site, account_id, account_name FROM s_base",
        "latest_entity_status": """
            SELECT 'ad' AS entity, site, id, ad_status AS status FROM s_ad_status
            UNION ALL SELECT 'adset', site, id, adgroup_status FROM s_adset_status
            UNION ALL SELECT 'campaign', site, id, campaign_status FROM s_campaign_status""",
        "social_status_attach": """
            SELECT site, ad_id, adgroup_id, campaign_id, date, ad_status, adgroup_status,
                   campaign_status, impressions FROM s_with_status""",
        "action_unnest": "SELECT * FROM s_stats",
        "action_pivot_ad": "SELECT * FROM s_ad_stats",
        "action_pivot_adset": _pivot(["campaign_id", "adset_id", "date_start"], "adset"),
        "action_pivot_campaign": _pivot(["campaign_id", "date_start"], "campaign"),
        "ad_latest_received": """
            SELECT site, ad_id, max(_sdc_received_at) AS _sdc_received_at FROM si
            GROUP BY site, ad_id""",
        "social_ads_daily": "SELECT * FROM s_daily",
        # --- views ---
        "view_ppc_creatives": _view_creatives("creatives_daily"),
        "view_ppc_keywords": _view_keywords("keywords_daily"),
        "view_social": f"""
            SELECT {SOCIAL_KEYS}, CAST(sum(impressions) AS BIGINT) AS impressions,
                   CAST(sum(clicks) AS BIGINT) AS clicks, sum(cost) AS cost,
                   CAST(sum(link_clicks) AS BIGINT) AS link_clicks,
                   CAST(sum(post_reactions_ad) AS BIGINT) AS post_reactions_ad,
                   CAST(sum(link_clicks_ad) AS BIGINT) AS link_clicks_ad,
                   CAST(sum(likes_ad) AS BIGINT) AS likes_ad
            FROM s_daily GROUP BY site, {SOCIAL_KEYS}""",
        "view_all_ppc_creatives": _view_creatives("creatives_daily") + "\nUNION ALL\n"
                                  + _view_creatives("display_creatives_daily"),
        "view_all_ppc_keywords": _view_keywords("keywords_daily") + "\nUNION ALL\n"
                                 + _view_keywords("display_keywords_daily"),
        "publish_roundtrip": "SELECT * FROM creatives_daily",
        "publish_versions": """SELECT * FROM display_keywords_daily
            WHERE site <> 'EUROPE' AND (site <> 'ASIA' OR clicks > 3)""",
        "csv_export_roundtrip": "SELECT * FROM keywords_daily",
    }
    return {k: _with(v, config, as_of) for k, v in q.items()}
