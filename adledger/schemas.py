"""Pinned schemas of the raw network reports and of the published datasets.

Raw reports are append-only: every load of a report is appended with its
load time (``_sdc_report_datetime`` for reports, ``_sdc_received_at`` for
entity tables).  All raw tables carry an extra ``site`` column, which is the
partition column on disk, so one DataFrame covers every site.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Search network ad report (money in micros).
GOOGLE_ADS = _schema(
    ("site", S), ("account", S), ("customerid", L), ("campaignid", L), ("campaign", S),
    ("adgroupid", L), ("adgroup", S), ("adid", L), ("clicktype", S), ("clicks", L),
    ("impressions", L), ("cost", L), ("finalurl", S), ("headline1", S), ("headline2", S),
    ("expandedtextadheadline3", S), ("description", S), ("expandedtextaddescription2", S),
    ("descriptionline1", S), ("descriptionline2", S), ("adgroupstate", S),
    ("campaignstate", S), ("adstate", S), ("day", TS), ("_sdc_report_datetime", TS),
)

# Search network keyword report (money in micros).
GOOGLE_KEYWORDS = _schema(
    ("site", S), ("account", S), ("customerid", L), ("campaignid", L), ("adgroupid", L),
    ("adgroup", S), ("keywordid", L), ("keyword", S), ("clicktype", S), ("clicks", L),
    ("impressions", L), ("cost", L), ("maxcpc", L), ("matchtype", S), ("adgroupstate", S),
    ("campaignstate", S), ("keywordstate", S), ("day", TS), ("_sdc_report_datetime", TS),
)

# S3: search network campaign report (budget in micros).
GOOGLE_CAMPAIGN_REPORT = _schema(
    ("site", S), ("campaignid", L), ("campaign", S), ("budgetid", L),
    ("hasrecommendedbudget", B), ("budgetperiod", S), ("budget", L),
    ("_sdc_report_datetime", TS),
)

# Search network campaign entity.
GOOGLE_CAMPAIGNS = _schema(("site", S), ("id", L), ("name", S))

# Search partner ad report (money in currency units).
BING_ADS = _schema(
    ("site", S), ("accountname", S), ("accountid", L), ("campaignid", L), ("campaignname", S),
    ("adgroupid", L), ("adgroupname", S), ("adid", L), ("impressions", L), ("clicks", L),
    ("spend", D), ("finalurl", S), ("titlepart1", S), ("titlepart2", S), ("addescription", S),
    ("adgroupstatus", S), ("campaignstatus", S), ("adstatus", S), ("timeperiod", TS),
    ("_sdc_report_datetime", TS),
)

# Search partner keyword report.
BING_KEYWORDS = _schema(
    ("site", S), ("accountname", S), ("accountid", L), ("campaignid", L), ("campaignname", S),
    ("adgroupid", L), ("adgroupname", S), ("keywordid", L), ("keyword", S), ("impressions", L),
    ("clicks", L), ("spend", D), ("bidmatchtype", S), ("adgroupstatus", S),
    ("campaignstatus", S), ("keywordstatus", S), ("timeperiod", TS), ("_sdc_report_datetime", TS),
)

# Search partner campaign entity (daily budget in units).
BING_CAMPAIGNS = _schema(("site", S), ("id", L), ("dailybudget", D))

# Social entities.
SOCIAL_CAMPAIGNS = _schema(
    ("site", S), ("id", L), ("account_id", S), ("name", S), ("effective_status", S),
    ("_sdc_received_at", TS),
)
SOCIAL_ADSETS = _schema(("site", S), ("id", L), ("effective_status", S), ("_sdc_received_at", TS))
SOCIAL_ADS = _schema(("site", S), ("id", L), ("effective_status", S), ("_sdc_received_at", TS))

ACTION = T.StructType([
    T.StructField("value", T.StructType([
        T.StructField("action_type", S, True),
        T.StructField("value", L, True),
    ]), True),
])

# Social insights with the nested, repeated action record.
SOCIAL_INSIGHTS = _schema(
    ("site", S), ("campaign_id", L), ("adset_id", L), ("adset_name", S), ("ad_id", L),
    ("ad_name", S), ("date_start", TS), ("impressions", L), ("clicks", L), ("spend", D),
    ("reach", L), ("frequency", D), ("inline_link_clicks", L),
    ("actions", T.ArrayType(ACTION, True)), ("_sdc_received_at", TS),
)

# Published dataset column orders (positional order matters for the unions).
CREATIVE_COLUMNS = [
    "account_id", "campaign_id", "adgroup_id", "creative_id", "date", "platform", "account",
    "adgroup", "campaign", "impressions", "clicks", "cost", "url", "headline1", "headline2",
    "headline3", "description", "adgroup_state", "campaign_state", "creative_state", "budget",
]
KEYWORD_COLUMNS = [
    "account_id", "campaign_id", "adgroup_id", "keyword_id", "date", "platform", "account",
    "adgroup", "campaign", "keyword", "impressions", "clicks", "cost", "adgroup_state",
    "campaign_state", "keyword_state", "match_type", "max_cpc", "budget",
]
SOCIAL_COLUMNS = [
    "date", "account_name", "account_id", "campaign_id", "campaign_name", "adgroup_id",
    "adgroup_name", "ad_id", "ad_name", "campaign_status", "adgroup_status", "ad_status",
    "impressions", "clicks", "cost", "link_clicks", "post_reactions_ad", "link_clicks_ad",
    "likes_ad",
]

CREATIVE_SUMS = ["impressions", "clicks", "cost"]
CREATIVE_KEYS = [c for c in CREATIVE_COLUMNS if c not in CREATIVE_SUMS]
KEYWORD_SUMS = ["impressions", "clicks", "cost"]
KEYWORD_KEYS = [c for c in KEYWORD_COLUMNS if c not in KEYWORD_SUMS + ["max_cpc"]]
SOCIAL_SUMS = SOCIAL_COLUMNS[12:]
SOCIAL_KEYS = SOCIAL_COLUMNS[:12]
