"""Union views over the per-site datasets.

The reference writes one UNION ALL branch per site dataset, each re-summed on
its own.  Here a dataset holds all sites, so a branch is (dataset, site) and
the re-aggregation groups by ``site`` plus the view keys; ``site`` is not
output (T27).  The all-PPC views add the display datasets as a second source
and keep the two sources apart the same way (T9).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from adledger import schemas
from adledger.operators.rollup import view_rollup
from adledger.sources import versions


def _creatives(ds: DataFrame) -> DataFrame:
    out = view_rollup(ds, schemas.CREATIVE_KEYS, schemas.CREATIVE_SUMS,
                      casts={"date": "date", "headline3": "string"})
    return out.select(*schemas.CREATIVE_COLUMNS)


def _keywords(ds: DataFrame) -> DataFrame:
    out = view_rollup(ds, schemas.KEYWORD_KEYS, schemas.KEYWORD_SUMS, maxes=("max_cpc",),
                      casts={"date": "date"})
    return out.select(*schemas.KEYWORD_COLUMNS)


def view_ppc_creatives(ppc_creatives: DataFrame) -> DataFrame:
    """All sites' non-display creatives."""
    return _creatives(ppc_creatives)


def view_ppc_keywords(ppc_keywords: DataFrame) -> DataFrame:
    """All sites' non-display keywords."""
    return _keywords(ppc_keywords)


def view_social(social_ads: DataFrame) -> DataFrame:
    """All sites' social ads (raw ``date``, as the social view does not cast it)."""
    out = view_rollup(social_ads, schemas.SOCIAL_KEYS, schemas.SOCIAL_SUMS)
    return out.select(*schemas.SOCIAL_COLUMNS)


def view_all_ppc_creatives(ppc_creatives: DataFrame, display_creatives: DataFrame) -> DataFrame:
    """Non-display and 'display' creatives (the latter holds every campaign, T9)."""
    return _creatives(ppc_creatives).unionByName(_creatives(display_creatives))


def view_all_ppc_keywords(ppc_keywords: DataFrame, display_keywords: DataFrame) -> DataFrame:
    """P10: non-display and display keywords."""
    return _keywords(ppc_keywords).unionByName(_keywords(display_keywords))


def union_views(ppc_creatives: DataFrame, display_creatives: DataFrame,
                ppc_keywords: DataFrame, display_keywords: DataFrame,
                social_ads: DataFrame) -> dict[str, DataFrame]:
    """The five union views over the five datasets."""
    return {
        "view_ppc_creatives": view_ppc_creatives(ppc_creatives),
        "view_ppc_keywords": view_ppc_keywords(ppc_keywords),
        "view_social": view_social(social_ads),
        "view_all_ppc_creatives": view_all_ppc_creatives(ppc_creatives, display_creatives),
        "view_all_ppc_keywords": view_all_ppc_keywords(ppc_keywords, display_keywords),
    }


def register_views(*datasets: DataFrame) -> dict[str, DataFrame]:
    """O-VIEW: register the union views (arguments as ``union_views``) as temporary views for SQL users."""
    built = union_views(*datasets)
    for name, df in built.items():
        df.createOrReplaceTempView(name)
    return built


# Dataset -> the keys that its roll-up groups by beside the site: no two published rows share them.
UNIQUE_BY = {"ppc_creatives": schemas.CREATIVE_KEYS, "display_creatives": schemas.CREATIVE_KEYS,
             "ppc_keywords": schemas.KEYWORD_KEYS, "display_keywords": schemas.KEYWORD_KEYS,
             "social_ads": schemas.SOCIAL_KEYS}
_COLUMNS = {"ppc_creatives": schemas.CREATIVE_COLUMNS, "display_creatives": schemas.CREATIVE_COLUMNS,
            "ppc_keywords": schemas.KEYWORD_COLUMNS, "display_keywords": schemas.KEYWORD_COLUMNS,
            "social_ads": schemas.SOCIAL_COLUMNS}
# View -> the datasets whose branches it unites.
VIEWS = {"view_ppc_creatives": ("ppc_creatives",), "view_ppc_keywords": ("ppc_keywords",), "view_social": ("social_ads",),
         "view_all_ppc_creatives": ("ppc_creatives", "display_creatives"),
         "view_all_ppc_keywords": ("ppc_keywords", "display_keywords")}


def _published_branch(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A view's branch over the published dataset.

    The view sums rows that share site and keys.  Where the commit records that
    none do, every sum is over one row: the branch is a projection of the scan.
    """
    path = f"{root.rstrip('/')}/{name}"
    last, keys = versions.current(spark, path), ["site", *UNIQUE_BY[name]]
    rows = versions.read_version(spark, path, last)
    if last.unique_by and set(last.unique_by) <= set(keys):
        return rows.select(*_COLUMNS[name])
    roll = {"social_ads": view_social}.get(name, _keywords if name.endswith("keywords") else _creatives)
    return roll(rows)


def published_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The five union views over the datasets published under ``root`` (their last commits)."""
    branches = {n: _published_branch(spark, root, n) for n in UNIQUE_BY}
    return {view: reduce(DataFrame.unionByName, [branches[n] for n in names]) for view, names in VIEWS.items()}
