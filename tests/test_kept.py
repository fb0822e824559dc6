"""Kept snapshots: loads merged one by one, and days read again, equal the pick of the whole report."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from adledger.config import TEST_SITES
from adledger.operators import search
from adledger.operators.snapshot import latest_snapshot
from adledger.plans import ppc
from adledger.session import scratch_path
from adledger.sources import kept, versions
from conftest import ts

KEYS, TS = ["site", "adgroup", "day"], "_sdc_report_datetime"


def bag(df, cols):
    return sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())


def loads(rng, n):
    """Loads whose rows come in any order of their load times: late ones, ties, repeated rows, null keys."""
    def row():
        return dict(site=rng.choice(["S", "T", "U"]), adgroup=rng.choice(["G", "H", None]), day=ts(rng.randint(1, 4)),
                    adid=rng.randint(1, 3), clicks=rng.randint(0, 2), _sdc_report_datetime=rng.choice([ts(5), ts(6), ts(7), None]))
    return [[row() for _ in range(rng.randint(1, 12))] for _ in range(n)]


def test_loads_merged_one_by_one_equal_the_full_pick(spark, mk):
    path, given = scratch_path(spark, "kept"), loads(random.Random(3), 4)
    seen = []
    for i, rows in enumerate(given):
        seen += rows
        for _ in range(2 if i in (1, 3) else 1):   # a retried refresh merges the same load again
            kept.merge_load(mk.google_ads(*rows), path, KEYS, TS, f"load {i}")
        whole = mk.google_ads(*seen)
        assert bag(kept.read_kept(spark, path), whole.columns) == bag(latest_snapshot(whole, KEYS, TS), whole.columns)
    assert kept.read_kept(spark, path).columns == mk.google_ads(*seen).columns


def test_a_load_touches_only_its_sites(spark, mk):
    path = scratch_path(spark, "kept-sites")
    kept.merge_load(mk.google_ads(dict(site="S"), dict(site="T")), path, KEYS, TS, "a")
    before = versions.current(spark, path).folders
    kept.merge_load(mk.google_ads(dict(site="T", _sdc_report_datetime=ts(9)), dict(site="X"), dict(site=None)),
                    path, KEYS, TS, "b", sites=["S", "T"])
    after = versions.current(spark, path).folders
    assert after["S"] == before["S"] and after["T"] != before["T"] and set(after) == {"S", "T"}
    assert kept.merge_load(mk.google_ads(dict(site="X")), path, KEYS, TS, "c", sites=["S", "T"]) is None
    assert kept.merge_load(mk.google_ads(), path, KEYS, TS, "d") is None
    assert len(versions.history(spark, path)) == 2
    with pytest.raises(ValueError):
        kept.merge_load(mk.google_ads(dict()), path, ["adgroup", "day"], TS, "e")


def test_a_failed_merge_leaves_the_rows_of_the_last_one(spark, mk, monkeypatch):
    path, first = scratch_path(spark, "kept-fail"), mk.google_ads(dict(site="S", clicks=1))
    kept.merge_load(first, path, KEYS, TS, "a")
    late = mk.google_ads(dict(site="S", clicks=2, _sdc_report_datetime=ts(9)))

    def broken(*_):
        raise OSError("storage is gone")

    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", broken)
        with pytest.raises(OSError):
            kept.merge_load(late, path, KEYS, TS, "b")
    assert [r.clicks for r in kept.read_kept(spark, path).collect()] == [1]
    kept.merge_load(late, path, KEYS, TS, "b")
    assert [r.clicks for r in kept.read_kept(spark, path).collect()] == [2]


def test_days_read_again_equal_the_full_pick(spark, mk):
    rng = random.Random(4)
    old, new = loads(rng, 2)
    new = [r for r in new if r["day"] >= ts(3)] + [dict(day=ts(3), _sdc_report_datetime=ts(9))]
    whole, before = mk.google_ads(*old, *new), mk.google_ads(*old)
    got = kept.restate_since(latest_snapshot(before, KEYS, TS), whole, KEYS, TS, "day", "2024-01-03")
    assert bag(got, whole.columns) == bag(latest_snapshot(whole, KEYS, TS), whole.columns)
    with pytest.raises(ValueError):   # a bound on another column would drop loads, not keys
        kept.restate_since(before, whole, KEYS, TS, TS, "2024-01-03")


def test_datasets_of_kept_rows_equal_those_of_the_report(spark, mk):
    site = TEST_SITES[0].site
    rows = [dict(site=site, adid=a, clicktype=c, clicks=a, day=ts(d), _sdc_report_datetime=ts(t))
            for a in (1, 2) for c in (search.HEADLINE, search.PHONE) for d in (1, 2) for t in (4, 3)]
    budget = mk.campaign_report(dict(site=site))
    path = scratch_path(spark, "kept-dataset")
    for i in (1, 0):
        kept.merge_load(mk.google_ads(*rows[i::2]), path, KEYS, TS, str(i))
    want = ppc.display_creatives(mk.google_ads(*rows), budget, TEST_SITES)
    got = ppc.display_creatives(kept.read_kept(spark, path), budget, TEST_SITES)
    assert bag(got, want.columns) == bag(want, want.columns) and want.count()
    assert kept.read_kept(spark, path).where(F.col("site") == site).count() == len(rows) // 2
