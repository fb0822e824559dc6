"""Site configuration.

Each site has some of three networks (search, search partner, social) and a
little schema drift in its search ad report (no third headline, description
built from three legacy parts).  The configuration is a short driver-side
list, one entry per site, so it is bounded by the number of sites and never
by the data: turning it into a DataFrame and broadcasting it is safe.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

NETWORKS = ("google", "bing", "facebook")


@dataclass(frozen=True)
class SiteConfig:
    site: str
    google: bool = False
    bing: bool = False
    facebook: bool = False
    has_headline3: bool = True
    three_part_description: bool = False
    adset_like: str | None = None          # extra LIKE filter on the social ad-set name
    social_account_id: str | None = None   # social account id (text) owned by the site
    account_name: str | None = None        # name the social account id is reported as
    # Network -> where the site's reports of it lie: a folder, or a pattern with {report} (sources.locations).
    sources: dict[str, str] = field(default_factory=dict, compare=False)


def load_sites(path: str) -> list[SiteConfig]:
    """Read the site configuration from a JSON list of objects with SiteConfig fields."""
    known = {f.name for f in fields(SiteConfig)}
    with open(path) as fh:
        entries = json.load(fh)
    out = []
    for e in entries:
        unknown = set(e) - known
        if unknown:
            raise ValueError(f"unknown site config fields {sorted(unknown)} in {e.get('site')!r}")
        out.append(SiteConfig(**e))
    return out


def sites_with(config: list[SiteConfig], network: str) -> list[str]:
    """O-SITES: the sites that have ``network`` configured."""
    if network not in NETWORKS:
        raise ValueError(f"unknown network {network!r}")
    return [c.site for c in config if getattr(c, network)]


def sites_where(config: list[SiteConfig], flag: str, value=True) -> list[str]:
    return [c.site for c in config if getattr(c, flag) == value]


def account_name(account_id: Column, config: list[SiteConfig]) -> Column:
    """The reported name of a social account id: the first configured match, else null."""
    out = F.lit(None).cast("string")
    for c in reversed(config):
        if c.social_account_id is not None:
            out = F.when(account_id == c.social_account_id, F.lit(c.account_name)).otherwise(out)
    return out


def adset_patterns(config: list[SiteConfig]) -> dict[str, str]:
    return {c.site: c.adset_like for c in config if c.adset_like}


# Configuration used with the seeded test tables (FIXTURES.md).  It mirrors the
# kinds of drift the production configuration has: two sites without a third
# headline, two with three-part descriptions, one search site without the
# search partner network, and one social site with an ad-set filter.
TEST_SITES: list[SiteConfig] = [
    SiteConfig("AFRICA", google=True, bing=True, has_headline3=False),
    SiteConfig("AMERICA", google=True, bing=True, has_headline3=False, three_part_description=True),
    SiteConfig("ASIA", google=True, bing=True, three_part_description=True),
    SiteConfig("EUROPE", google=True, bing=True),
    SiteConfig("MIDDLE EAST", google=True),
    SiteConfig("0", facebook=True, social_account_id="0", account_name="site0.example"),
    SiteConfig("1", facebook=True, social_account_id="1", account_name="site1.example"),
    SiteConfig("2", facebook=True, social_account_id="2", account_name="site2.example"),
    SiteConfig("3", facebook=True, social_account_id="3", account_name="site3.example"),
    SiteConfig("4", facebook=True, social_account_id="4", account_name="site4.example",
               adset_like="%hernia%mesh%"),
]
