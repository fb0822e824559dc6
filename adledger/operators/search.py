"""Search network (ad and keyword report) steps of the PPC datasets.

Plan shape.  The reference reads the fact report four times (snapshot pick,
clicks/cost, headline impressions, phone impressions).  Here the latest load
of each (site, ad group, day) comes from a narrow scan of those columns,
combined map-side; the report is joined to these maxima, so most of the
history is gone before anything wide is shuffled.  The rows picked are then
aggregated once to the finest key any consumer needs (ad texts, states, day,
load time); clicks/cost per ad and impressions per click type are
re-aggregations of those *latest* rows.

The tail (DISTINCT, impressions, budget, DISTINCT, roll-up) has one layout, by
item: the staged rows and the staged attachments are each dealt by it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adledger.config import SiteConfig, sites_where
from adledger.functions import (ad_description, is_display, micros_to_units, not_display,
                                platform_tag, typed_null)
from adledger.operators.joins import salted_left_join
from adledger.operators.snapshot import latest_rows_distinct, latest_snapshot, with_multiplicity

TS = "_sdc_report_datetime"
# Parity: the latest load is picked per ad-group *name* and day.
SNAP_KEYS = ["site", "adgroup", "day"]
# Named correction, off by default: pick it per ad-group id and day.
SNAP_KEYS_BY_ID = ["site", "adgroupid", "day"]

# Click types whose impressions are attributed, and the network tag.
HEADLINE = "Headline"
PHONE = "Phone calls"
PLATFORM = "AdWords"

AD_FINE_KEYS = [
    "site", "account", "customerid", "campaignid", "campaign", "adgroupid", "adgroup", "adid",
    "finalurl", "headline1", "headline2", "expandedtextadheadline3",
    "description", "desc_part2", "desc_part3",
    "adgroupstate", "campaignstate", "adstate", "day", TS, "three_part",
]
KW_FINE_KEYS = [
    "site", "account", "customerid", "campaignid", "adgroupid", "adgroup", "keywordid",
    "keyword", "adgroupstate", "campaignstate", "keywordstate", "matchtype", "day", TS,
]


def _isin(sites: list[str]) -> Column:
    return F.col("site").isin(sites) if sites else F.lit(False)


def prepare_ads(report: DataFrame, config: list[SiteConfig]) -> DataFrame:
    """Per-site schema drift: null third headline, two- or three-part description."""
    no_h3 = _isin(sites_where(config, "has_headline3", False))
    three = _isin(sites_where(config, "three_part_description", True))
    return report.select(
        *[c for c in report.columns if c not in (
            "expandedtextadheadline3", "expandedtextaddescription2",
            "descriptionline1", "descriptionline2")],
        F.when(~no_h3, F.col("expandedtextadheadline3")).alias("expandedtextadheadline3"),
        F.when(three, F.col("descriptionline1"))
         .otherwise(F.col("expandedtextaddescription2")).alias("desc_part2"),
        F.when(three, F.col("descriptionline2")).alias("desc_part3"),
        three.alias("three_part"),
    )


def _clicktype_sums() -> list[Column]:
    head = F.col("clicktype") == HEADLINE
    phone = F.col("clicktype") == PHONE
    return [
        F.sum(F.when(head, F.col("impressions"))).alias("head_impressions"),
        F.count(F.when(head, 1)).alias("head_rows"),
        F.sum(F.when(phone, F.col("impressions"))).alias("phone_impressions"),
        F.count(F.when(phone, 1)).alias("phone_rows"),
    ]


def ad_fine(report: DataFrame, config: list[SiteConfig]) -> DataFrame:
    """Ad rows (the picked ones) summed at the finest key any step needs.

    ``search_rows`` evaluates the display exclusion inside the same aggregation
    (the campaign is a key, so it is the row predicate's value for the group),
    so one materialized fine table serves the display and the non-display
    datasets; read back from Parquet, the flag becomes a pushed-down filter.
    """
    return (prepare_ads(report, config)
            .groupBy(*AD_FINE_KEYS)
            .agg(F.sum("clicks").alias("clicks"),
                 F.sum("cost").alias("cost_micros"),
                 *_clicktype_sums(),
                 F.bool_or(not_display("campaign")).alias("search_rows")))


def keyword_fine(report: DataFrame) -> DataFrame:
    """Keyword rows (the picked ones) at the finest key (O-AGG-KW partials, max CPC in micros)."""
    return (report.groupBy(*KW_FINE_KEYS)
                  .agg(F.sum("clicks").alias("clicks"),
                       F.sum("cost").alias("cost_micros"),
                       F.max("maxcpc").alias("maxcpc_micros"),
                       *_clicktype_sums()))


def latest_rows(fine: DataFrame, keys: list[str] = SNAP_KEYS, times: DataFrame | None = None) -> DataFrame:
    """O-SNAP on (site, ad group *name*, day).

    Applied to raw rows before the fine aggregate.  Both orders give the same
    rows, as the key and the load time are among the fine keys.  ``times``: the
    maxima, if staged (``snapshot.staged_times``).
    """
    return latest_snapshot(fine, keys, TS, times)


def _description() -> Column:
    three = ad_description("description", "desc_part2", "desc_part3")
    two = ad_description("description", "desc_part2")
    return F.when(F.col("three_part"), three).otherwise(two).alias("description")


def _ad_select(df: DataFrame) -> DataFrame:
    return df.select(
        "site", "account", "customerid", platform_tag("account", PLATFORM).alias("platform"),
        "campaignid", "adgroupid", "adid", "adgroup", "campaign", "clicks", "cost_micros",
        "finalurl", "headline1", "headline2", "expandedtextadheadline3", _description(),
        "adgroupstate", "campaignstate", "adstate", "day", TS, *_layout(df))


def _layout(df: DataFrame) -> list[str]:
    """The layout's key, if the rows are dealt by it."""
    return [ITEM] if ITEM in df.columns else []


def search_ads(latest: DataFrame) -> DataFrame:
    """O-DISP-EX + O-AGG-AD: clicks and cost per ad, text, state, day; DISTINCT kept."""
    return _ad_select(latest.where(F.col("search_rows"))).distinct()


def all_ads_null_campaign(latest: DataFrame, only_display: bool = False) -> DataFrame:
    """Display-dataset variant: campaign a typed null.

    By default there is no campaign filter, as in the reference, whose filter
    is commented out (T9); ``only_display=True`` keeps display campaigns only.
    """
    keys = [*_layout(latest), *[k for k in AD_FINE_KEYS if k != "campaign"]]
    if only_display:
        latest = latest.where(is_display("campaign"))
    regrouped = (latest.groupBy(*keys)
                       .agg(F.sum("clicks").alias("clicks"),
                            F.sum("cost_micros").alias("cost_micros"))
                       .withColumn("campaign", typed_null()))
    return _ad_select(regrouped).distinct()


def clicktype_totals(latest: DataFrame, item_id: str) -> DataFrame:
    """O-CLICKTYPE + O-AGG-IMP: headline and phone impressions in one aggregation.

    Grouped by customer, campaign, ad group, item, day and load time like the
    reference; customer and load time are not join keys, so several rows per
    join key fan out in the attach step (T5).  A group exists for a click type
    only if it had rows of that type (``*_rows > 0``).
    """
    keys = ["site", "customerid", "campaignid", "adgroupid", item_id, "day", TS]
    return latest.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (
        "head_impressions", "head_rows", "phone_impressions", "phone_rows")])


def split_clicktypes(totals: DataFrame, item_id: str) -> tuple[DataFrame, DataFrame]:
    """The headline and phone tables, on the attach join keys."""
    join_keys = ["site", "campaignid", "adgroupid", item_id, "day"]
    head = totals.where(F.col("head_rows") > 0).select(*join_keys, "head_impressions")
    phone = totals.where(F.col("phone_rows") > 0).select(*join_keys, "phone_impressions")
    return head, phone


def clicktype_impressions(latest: DataFrame, item_id: str) -> tuple[DataFrame, DataFrame]:
    return split_clicktypes(clicktype_totals(latest, item_id), item_id)


def campaign_budget(campaign_report: DataFrame, staged: str | None = None) -> DataFrame:
    """O-BUDGET: budget rows at the latest load of each campaign (DISTINCT).

    ``staged`` names a staging table of the distinct rows; the report is then read once.
    """
    cols = ["site", "campaignid", "campaign", "budgetid", "hasrecommendedbudget",
            "budgetperiod", "budget", TS]
    keys = ["site", "campaignid"]
    latest = latest_rows_distinct(campaign_report, keys, TS, [c for c in cols if c not in (*keys, TS)], staged)
    return latest.select(
        "site", "campaignid", "campaign", "budgetid",
        F.col("hasrecommendedbudget").alias("has_recommended_budget"),
        F.col("budgetperiod").alias("budget_period"),
        micros_to_units("budget").alias("budget"),
    ).distinct()


# The layout of the tail: rows of one item lie together.  A struct of the ids, in which nulls are equal.
ITEM, DAY = "__item", "__day"


def _item(item_id: str) -> Column:
    return F.struct("site", F.col("campaignid").alias("campaign"), F.col("adgroupid").alias("adgroup"),
                    F.col(item_id).alias("item")).alias(ITEM)


def by_item(rows: DataFrame, item_id: str) -> DataFrame:
    """``rows`` dealt by item, a key finer than any hot campaign.

    DISTINCT, the attach join and the roll-up of an item's rows all keep to this
    layout (``session.apply_defaults``), so it is the one exchange of the rows.
    """
    return rows.withColumn(ITEM, _item(item_id)).repartition(ITEM)


def attachments(totals: DataFrame, budget: DataFrame, item_id: str) -> DataFrame:
    """O-CLICKTYPE's values and O-JOIN-BUD's budgets of every (item, day): DISTINCT (item keys, day, impressions, budget).

    Joining headline and then phone totals, each on the four keys and day, and
    taking the first that is not null gives, for each (item, day): every headline
    value that is not null; and, where there is no headline row or one is null,
    every phone value, or null if there is no phone row.  Null keys never match,
    so they have null impressions, but budgets by campaign.
    """
    keys = ["site", "campaignid", "adgroupid", item_id, "day"]
    same = Window.partitionBy(*keys)
    head, phone, value = F.col("head_rows") > 0, F.col("phone_rows") > 0, F.col("head_impressions")
    seen = totals.select(
        *keys, "head_impressions", "phone_impressions", head.alias("head"), phone.alias("phone"),
        F.max(head).over(same).alias("any_head"), F.max(phone).over(same).alias("any_phone"),
        F.max(head & value.isNull()).over(same).alias("null_head"))
    matched = _all_known(keys)
    open_ = matched & (~F.col("any_head") | F.col("null_head"))
    none = F.array().cast("array<bigint>")
    values = F.concat(
        F.when(matched & F.col("head") & value.isNotNull(), F.array(value)).otherwise(none),
        F.when(open_ & F.col("phone"), F.array("phone_impressions")).otherwise(none),
        F.when(~matched | (open_ & ~F.col("any_phone")), F.array(F.lit(None).cast("long"))).otherwise(none))
    given = seen.select(*keys, F.explode(values).alias("impressions")).distinct()
    budgets = budget.select("site", "campaignid", "budget").distinct()
    return salted_left_join(given, budgets, ["site", "campaignid"], ["adgroupid", item_id, "day"])


def _all_known(keys: list[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def attach_impressions_and_budget(items: DataFrame, attached: DataFrame, item_id: str) -> DataFrame:
    """O-JOIN-IMP + O-JOIN-BUD + DISTINCT (T5, T6, T11) of ``items`` dealt ``by_item``.

    One join: ``attachments`` has a row for every (item, day) of the report.
    """
    keys = ["site", "campaignid", "adgroupid", item_id, "day"]
    own = attached.select(_item(item_id), F.struct("day").alias(DAY), "impressions", "budget").repartition(ITEM)
    joined = items.withColumn(DAY, F.struct("day")).join(own, [ITEM, DAY], "left")
    cols = [c for c in items.columns if c not in (TS, ITEM, *keys)]
    return joined.select(ITEM, *keys, *cols, "impressions", "budget").distinct()


def campaign_names(campaigns: DataFrame) -> DataFrame:
    """Campaign dimension as (site, campaignid, campaign, multiplicity) for O-JOIN-DIM."""
    dim = campaigns.select("site", F.col("id").alias("campaignid"), F.col("name").alias("campaign"))
    return with_multiplicity(dim, ["site", "campaignid", "campaign"], "__n")


def keywords_with_campaign(latest: DataFrame, campaigns: DataFrame,
                           display: bool | None) -> DataFrame:
    """O-JOIN-DIM (inner, on id, no snapshot pick) then O-DISP-EX / O-DISP-ONLY on its name.

    Joining the fine rows to (id, name, count) and scaling the sums by the
    count equals summing the raw rows joined to a dimension with repeated ids.
    ``display=None`` applies no campaign filter.
    """
    names = campaign_names(campaigns)
    j = latest.join(names, ["site", "campaignid"], "inner")
    if display is not None:
        j = j.where(is_display("campaign") if display else not_display("campaign"))
    return j.select(
        "site", "account", "customerid", platform_tag("account", PLATFORM).alias("platform"),
        "campaignid", "adgroupid", "keywordid", "adgroup", "campaign", "keyword",
        (F.col("clicks") * F.col("__n")).alias("clicks"),
        (F.col("cost_micros") * F.col("__n")).alias("cost_micros"),
        "adgroupstate", "campaignstate", "keywordstate", "matchtype", "day", TS,
        "maxcpc_micros", *_layout(j),
    )


def normalize_ads(final_ads: DataFrame) -> DataFrame:
    """O-PROJ: search network rows in the common creative layout (money in micros)."""
    return final_ads.select(
        "site", "account", F.col("customerid").alias("account_id"), "platform",
        F.col("campaignid").alias("campaign_id"), F.col("adgroupid").alias("adgroup_id"),
        F.col("adid").alias("creative_id"), "adgroup", "campaign",
        F.coalesce("impressions", F.lit(0).cast("long")).alias("impressions"),
        "clicks", "cost_micros", F.col("finalurl").alias("url"), "headline1", "headline2",
        F.col("expandedtextadheadline3").alias("headline3"), "description",
        F.col("adgroupstate").alias("adgroup_state"),
        F.col("campaignstate").alias("campaign_state"),
        F.col("adstate").alias("creative_state"), F.col("day").alias("date"), "budget", *_layout(final_ads))


def normalize_keywords(final_kw: DataFrame) -> DataFrame:
    """O-PROJ for keywords: common keyword layout (money in micros)."""
    return final_kw.select(
        "site", "account", F.col("customerid").alias("account_id"), "platform",
        F.col("campaignid").alias("campaign_id"), F.col("adgroupid").alias("adgroup_id"),
        F.col("keywordid").alias("keyword_id"), "adgroup", "campaign", "keyword",
        F.coalesce("impressions", F.lit(0).cast("long")).alias("impressions"),
        "clicks", "cost_micros", F.col("adgroupstate").alias("adgroup_state"),
        F.col("campaignstate").alias("campaign_state"),
        F.col("keywordstate").alias("keyword_state"), F.col("matchtype").alias("match_type"),
        F.col("day").alias("date"), F.col("max_cpc_micros"), "budget", *_layout(final_kw))
