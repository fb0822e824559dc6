from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from adledger import schemas  # noqa: E402
from adledger.session import apply_defaults, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    checkpoint_dir(s)
    yield s


def ts(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour)


GOOGLE_AD = dict(
    site="S", account="acct", customerid=1, campaignid=1, campaign="Search one", adgroupid=10,
    adgroup="G", adid=100, clicktype="Headline", clicks=1, impressions=10, cost=1_000_000,
    finalurl="u", headline1="h1", headline2="h2", expandedtextadheadline3="h3",
    description="d", expandedtextaddescription2="e", descriptionline1="l1",
    descriptionline2="l2", adgroupstate="enabled", campaignstate="enabled", adstate="enabled",
    day=ts(1), _sdc_report_datetime=ts(2),
)
GOOGLE_KW = dict(
    site="S", account="acct", customerid=1, campaignid=1, adgroupid=10, adgroup="G",
    keywordid=100, keyword="kw", clicktype="Headline", clicks=1, impressions=10,
    cost=1_000_000, maxcpc=2_000_000, matchtype="Exact", adgroupstate="enabled",
    campaignstate="enabled", keywordstate="enabled", day=ts(1), _sdc_report_datetime=ts(2),
)
CAMPAIGN_REPORT = dict(
    site="S", campaignid=1, campaign="Search one", budgetid=5, hasrecommendedbudget=False,
    budgetperiod="DAILY", budget=7_000_000, _sdc_report_datetime=ts(2),
)
GOOGLE_CAMPAIGN = dict(site="S", id=1, name="Search one")
BING_AD = dict(
    site="S", accountname="bacct", accountid=2, campaignid=1, campaignname="Bing one",
    adgroupid=20, adgroupname="BG", adid=200, impressions=5, clicks=2, spend=1.5,
    finalurl="bu", titlepart1="t1", titlepart2="t2", addescription="bd",
    adgroupstatus="Active", campaignstatus="Active", adstatus="Active", timeperiod=ts(1),
    _sdc_report_datetime=ts(2),
)
BING_KW = dict(
    site="S", accountname="bacct", accountid=2, campaignid=1, campaignname="Bing one",
    adgroupid=20, adgroupname="BG", keywordid=7, keyword="bkw", impressions=5, clicks=2,
    spend=1.5, bidmatchtype="Exact", adgroupstatus="Active", campaignstatus="Active",
    keywordstatus="Active", timeperiod=ts(1), _sdc_report_datetime=ts(2),
)
BING_CAMPAIGN = dict(site="S", id=1, dailybudget=3.0)
INSIGHT = dict(
    site="S", campaign_id=1, adset_id=11, adset_name="Set", ad_id=111, ad_name="Ad",
    date_start=ts(1), impressions=10, clicks=2, spend=1.25, reach=8, frequency=1.0,
    inline_link_clicks=1, actions=None, _sdc_received_at=ts(1),
)
SOCIAL_CAMPAIGN = dict(site="S", id=1, account_id="42", name="Camp", effective_status="ACTIVE",
                       _sdc_received_at=ts(1))
SOCIAL_ADSET = dict(site="S", id=11, effective_status="ACTIVE", _sdc_received_at=ts(1))
SOCIAL_AD = dict(site="S", id=111, effective_status="ACTIVE", _sdc_received_at=ts(1))


def frame(spark, schema, base: dict | None, *rows: dict):
    """DataFrame with ``schema``; each row is ``base`` updated with the given fields."""
    out = []
    for r in rows:
        full = dict(base or {})
        full.update(r)
        out.append(tuple(full.get(f.name) for f in schema.fields))
    return spark.createDataFrame(out, schema)


def actions(*pairs):
    return [{"value": {"action_type": t, "value": v}} for t, v in pairs]


@pytest.fixture
def mk(spark):
    class Make:
        def google_ads(self, *rows):
            return frame(spark, schemas.GOOGLE_ADS, GOOGLE_AD, *rows)

        def google_keywords(self, *rows):
            return frame(spark, schemas.GOOGLE_KEYWORDS, GOOGLE_KW, *rows)

        def campaign_report(self, *rows):
            return frame(spark, schemas.GOOGLE_CAMPAIGN_REPORT, CAMPAIGN_REPORT, *rows)

        def google_campaigns(self, *rows):
            return frame(spark, schemas.GOOGLE_CAMPAIGNS, GOOGLE_CAMPAIGN, *rows)

        def bing_ads(self, *rows):
            return frame(spark, schemas.BING_ADS, BING_AD, *rows)

        def bing_keywords(self, *rows):
            return frame(spark, schemas.BING_KEYWORDS, BING_KW, *rows)

        def bing_campaigns(self, *rows):
            return frame(spark, schemas.BING_CAMPAIGNS, BING_CAMPAIGN, *rows)

        def insights(self, *rows):
            return frame(spark, schemas.SOCIAL_INSIGHTS, INSIGHT, *rows)

        def social_campaigns(self, *rows):
            return frame(spark, schemas.SOCIAL_CAMPAIGNS, SOCIAL_CAMPAIGN, *rows)

        def social_adsets(self, *rows):
            return frame(spark, schemas.SOCIAL_ADSETS, SOCIAL_ADSET, *rows)

        def social_ads(self, *rows):
            return frame(spark, schemas.SOCIAL_ADS, SOCIAL_AD, *rows)

    return Make()
