"""Versioned publishing: one-step commits, layout by site and day, views over published rows."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from adledger import schemas
from adledger.config import TEST_SITES
from adledger.plans import views
from adledger.plans.catalog import QUERIES
from adledger.session import scratch_path, stage_table, staged_paths, staging
from adledger.sources import versions

SF = "/root/testdata/sf0.001"


def bag(df, cols=None):
    return sorted(repr(tuple(r[c] for c in cols or df.columns)) for r in df.collect())


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "site string, n long, date string").withColumn("date", F.col("date").cast("date"))


def test_replaced_and_emptied_sites_change_together(spark):
    path = scratch_path(spark, "versions")
    first = table(spark, ("01", 1, "2024-01-01"), ("a b/c", 2, None), ("z", 3, "2024-02-01"))
    assert versions.current(spark, path) is None
    versions.publish_version(first, path)
    assert bag(versions.read_version(spark, path)) == bag(first)
    old = versions.read_version(spark, path)
    versions.publish_version(table(spark, ("01", 9, "2024-01-02")), path, sites=["01", "z"])
    now = bag(table(spark, ("01", 9, "2024-01-02"), ("a b/c", 2, None)))
    assert bag(versions.read_version(spark, path)) == now
    assert bag(old) == bag(first)                                   # a reader that had begun
    assert bag(versions.read_version(spark, path, 1)) == bag(first)  # and one that asks for it
    versions.publish_version(table(spark, ("x", 0, None)).where("false"), path, sites=["01", "a b/c"])
    assert versions.read_version(spark, path).count() == 0
    assert versions.read_version(spark, path).schema == first.schema


def test_a_failure_before_the_commit_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "versions-fail")
    first = table(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"))
    versions.publish_version(first, path)

    def broken(*_):
        raise OSError("storage is gone")

    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", broken)
        with pytest.raises(OSError):
            versions.publish_version(table(spark, ("a", 5, "2024-01-01")), path, sites=["a", "b"])
    assert bag(versions.read_version(spark, path)) == bag(first)
    versions.publish_version(table(spark, ("a", 5, "2024-01-01")), path, sites=["a", "b"])
    assert bag(versions.read_version(spark, path)) == bag(table(spark, ("a", 5, "2024-01-01")))


def test_a_publisher_that_was_overtaken_is_told(spark, monkeypatch):
    path = scratch_path(spark, "versions-two")
    versions.publish_version(table(spark, ("a", 1, None)), path)
    before = versions.current(spark, path)
    versions.publish_version(table(spark, ("a", 2, None)), path)
    real = versions.current
    monkeypatch.setattr(versions, "current", lambda s, p: before)
    with pytest.raises(RuntimeError, match="another publisher"):
        versions.publish_version(table(spark, ("a", 3, None)), path)
    monkeypatch.setattr(versions, "current", real)
    with pytest.raises(ValueError, match="without a site"):
        versions.publish_version(table(spark, (None, 3, None)), path)
    with pytest.raises(ValueError, match="columns differ"):
        versions.publish_version(table(spark, ("b", 3, None)).withColumn("m", F.lit(1)), path)


def test_site_and_day_filters_prune_folders_and_vacuum_keeps_the_last(spark):
    path = scratch_path(spark, "versions-layout")
    rows = table(spark, *[(s, d, f"2024-01-0{d}") for s in "ab" for d in (1, 2, 3)])
    versions.publish_version(rows, path)
    one = versions.read_version(spark, path).where("site = 'a' and date = date '2024-01-02'")
    assert [tuple(r)[:2] for r in one.collect()] == [("a", 2)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(site" in plan and "PushedFilters: []" in plan
    for n in range(3):
        versions.publish_version(table(spark, ("a", n, "2024-01-01")), path)
    dead = versions.vacuum(spark, path, keep=1)
    root = path.removeprefix("file:")
    assert len(dead) == 2 and not any(os.path.exists(f"{root}/{d}") for d in dead)
    assert bag(versions.read_version(spark, path)) == bag(
        table(spark, ("a", 2, "2024-01-01"), *[("b", d, f"2024-01-0{d}") for d in (1, 2, 3)]))


def test_dates_with_a_time_of_day_keep_it(spark):
    path = scratch_path(spark, "versions-times")
    rows = spark.sql("select 's' as site, timestamp_ntz'2024-01-01 13:00:00' as date, 1 as n union all select 's', null, 2")
    versions.publish_version(rows, path)
    assert bag(versions.read_version(spark, path)) == bag(rows)
    assert os.path.isdir(f"{path.removeprefix('file:')}/{versions.current(spark, path).folder}/site=s/day=2024-01-01")


def test_views_over_published_rows_shuffle_nothing_and_last_in_other_sessions(spark):
    root = scratch_path(spark, "versions-views")
    paid, shown = (stage_table(QUERIES[q](spark, SF).where("date < '1993-01-01'"), "published")
                   for q in ("ppc_creatives_daily", "display_creatives_daily"))
    want = bag(views.view_all_ppc_creatives(paid, shown), schemas.CREATIVE_COLUMNS)
    for name, df in (("ppc_creatives", paid), ("display_creatives", shown)):
        versions.publish_version(df, f"{root}/{name}", [c.site for c in TEST_SITES], unique_by=["site", *views.UNIQUE_BY[name]])
    view = views._published_branch(spark, root, "ppc_creatives").unionByName(
        views._published_branch(spark, root, "display_creatives"))
    assert "Exchange" not in view._jdf.queryExecution().executedPlan().toString()
    assert bag(view, schemas.CREATIVE_COLUMNS) == want
    # Without the record of unique keys the rows are summed again.
    versions.publish_version(paid.unionByName(paid), f"{root}/ppc_creatives")
    doubled = views._published_branch(spark, root, "ppc_creatives")
    assert bag(doubled.select("clicks").agg(F.sum("clicks"))) == bag(paid.agg(2 * F.sum("clicks")), [0])
    assert doubled.count() == paid.count()
    other = spark.newSession()
    path = f"{root}/view"
    versions.publish_version(view, path, by_site=False)
    held = versions.read_version(other, path)
    versions.publish_version(view.limit(0), path, by_site=False)   # a refresh while the other session reads
    assert held.count() == len(want) and versions.read_version(other, path).count() == 0


def test_a_staging_scope_drops_its_own_tables_only(spark):
    outer = stage_table(spark.range(3), "outer")
    with staging():
        inner = staged_paths(stage_table(spark.range(4), "inner"))
        with pytest.raises(ValueError), staging():
            stage_table(spark.range(5), "innermost")
            raise ValueError
        assert all(os.path.isdir(p.removeprefix("file:")) for p in inner)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in inner)
    assert outer.count() == 3 and staged_paths(outer)


def test_export_evaluates_each_row_once_whatever_the_number_of_sites(spark):
    from adledger.sources import sinks
    path, seen = scratch_path(spark, "export-once"), spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(s, n) for s in ("a", "b/c", "d") for n in range(5)], "site string, n long")

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    counted = rows.mapInPandas(count, rows.schema)
    sinks.export_csv(counted, path, ["a", "b/c", "d", "e"])
    assert seen.value == 15
    assert sorted(os.listdir(path.removeprefix("file:"))) == ["a", "b%2Fc", "d", "e"]
    assert bag(sinks.read_csv_export(spark, path, rows.drop("site").schema, ["a", "b/c", "d", "e"]), ["site", "n"]) == bag(rows)


def test_refresh_by_commits_passes_over_other_sites(spark):
    from adledger.streaming.refresh import refresh_on_new_loads
    raw, path = scratch_path(spark, "refresh-raw"), scratch_path(spark, "refresh-versions")
    rows = table(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"), ("other", 3, "2024-01-01"))
    rows.write.partitionBy("site").parquet(raw)

    def build(sites):
        return spark.read.schema(rows.schema).parquet(raw)

    for _ in range(2):
        refresh_on_new_loads(spark, raw, rows.schema, build, path, f"{path}-checkpoint", sites=["a", "b"],
                             publisher=versions.publish_version).awaitTermination(120)
    assert bag(versions.read_version(spark, path), rows.columns) == bag(rows.where("site != 'other'"))
    assert versions.current(spark, path).version == 1
