"""Checks and Gold kept per bucket: equal to whole runs, from the touched buckets only."""

import os
import random

import pytest

from millrace.operators import quality, rollup, summary
from millrace.plans import refinery
from millrace.sources import buckets, tables
from tests.conftest import rows
from tests.test_buckets import bucket_of, files_of

BY = (buckets.BUCKET,)


def made(n, seed, first=0):
    rng = random.Random(seed)
    return [
        (f"O{first + i}", f"u{i % 7}", f"p{rng.randint(0, 5)}", rng.randint(1, 90_000) / 100, rng.randint(1, 9))
        for i in range(n)
    ]


def whole(spark, layout, cents):
    silver = buckets.read(spark, layout.silver)
    return rows(summary.product_summary(silver, cents)), rows(quality.check_results(silver))


@pytest.mark.parametrize("cents", [True, False])
def test_waves_equal_a_whole_run(spark, orders, tmp_path, cents):
    layout = refinery.Layout.under(str(tmp_path))
    waves = [made(300, 1), made(40, 2, first=280), [("O5", "u", None, 3.5, 2), ("O999", "u", "p9", 1.0, 1)]]
    for n, wave in enumerate(waves):
        if n < 2:
            results = refinery.run(spark, orders(wave), layout, whole_cents=cents)
        else:
            with pytest.raises(quality.GateFailed, match="NotBeNull"):
                refinery.run(spark, orders(wave), layout, whole_cents=cents)
            continue
        gold, checks = whole(spark, layout, cents)
        found = rows(tables.read_snapshot(spark, layout.gold))
        assert len(found) == len(gold)
        for a, b in zip(found, gold):
            assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], abs=0.011 if not cents else 0)
        assert rows(results) == checks
    # The refused wave is in Silver and in the counts; Gold is as it was before, and right again later.
    counts = rollup.read(spark, layout.silver, layout.checks, quality.COUNTS)
    assert rows(quality.results_of(counts)) == whole(spark, layout, cents)[1]
    refinery.run(spark, orders([("O5", "u", "p1", 3.5, 2)]), layout, whole_cents=cents)
    assert [r[:3] for r in rows(tables.read_snapshot(spark, layout.gold))] == [r[:3] for r in whole(spark, layout, cents)[0]]


def test_only_touched_buckets_are_worked_out_anew(spark, orders, tmp_path):
    layout = refinery.Layout.under(str(tmp_path))
    buckets.seed(spark, layout.silver, orders(made(500, 3)), "order_id", n_buckets=32)
    refinery.run(spark, orders(made(1, 4)), layout, whole_cents=True)
    before = {path: files_of(path) for path in (layout.checks, layout.sums(True))}
    refinery.run(spark, orders([("O77", "u", "p1", 2.0, 3)]), layout, whole_cents=True)
    for path, old in before.items():
        new = files_of(path)
        written = {bucket_of(f) for f in set(new) - set(old)}
        assert len(written) == 1
        assert new.items() >= {f: t for f, t in old.items() if bucket_of(f) not in written}.items()


def test_counting_keys_of_a_bucket_needs_no_shuffle(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    buckets.seed(spark, path, orders(made(200, 5)), "order_id")
    found = buckets.layout(spark, path)
    counts = quality.unexpected(buckets.scan(spark, found, buckets.numbers(spark, found)), BY)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("order_id" in line for line in exchanges)


def test_what_a_stopped_run_left_out_is_made_up_for(spark, orders, tmp_path):
    layout = refinery.Layout.under(str(tmp_path))
    refinery.run(spark, orders(made(100, 6)), layout, whole_cents=True)
    # A merge whose refresh never came.
    buckets.merge(spark, layout.silver, orders([("O1", "u", "p0", 9.0, 9)]), before_write=layout.forget(spark))
    assert len(rollup.stale(spark, layout.silver, layout.checks)) == 1
    refinery.run(spark, orders([("O2", "u", "p0", 8.0, 8)]), layout, whole_cents=True)
    assert rows(tables.read_snapshot(spark, layout.gold)) == whole(spark, layout, True)[0]
    assert rollup.stale(spark, layout.silver, layout.checks) == set()


def test_results_follow_a_table_that_gets_more_buckets(spark, orders, tmp_path):
    table, path = str(tmp_path / "t"), str(tmp_path / "r")
    buckets.seed(spark, table, orders(made(50, 7)), "order_id")
    partial = lambda df: summary.partial_sums(df, True, BY)
    rollup.refresh(spark, table, path, partial)
    buckets.merge(spark, table, orders(made(3_000, 8)), bucket_bytes=500)
    assert buckets.layout(spark, table).n_buckets > 8
    rollup.refresh(spark, table, path, partial)
    gold = summary.summed_up(rollup.read(spark, table, path, summary.parts_schema(True)), True)
    assert rows(gold) == rows(summary.product_summary(buckets.read(spark, table), True))


def test_rows_without_keys_and_empty_tables(spark, orders, tmp_path):
    table, path = str(tmp_path / "t"), str(tmp_path / "r")
    none = rollup.read(spark, table, path, quality.COUNTS)
    assert {r["success"] for r in quality.results_of(none).collect()} == {True}
    schema = "order_id string, user_id string, product string, price double, quantity int"
    odd = [(None, "u", "p", 1.0, 1), (None, "u", None, -1.0, 1), ("a", "u", "p", None, None), ("a", "u", "p", 1.0, 0)]
    df = spark.createDataFrame(odd, schema)
    buckets.seed(spark, table, df, "order_id")
    rollup.refresh(spark, table, path, lambda df: quality.unexpected(df, BY))
    counts = rollup.read(spark, table, path, quality.COUNTS)
    assert rows(quality.results_of(counts)) == rows(quality.check_results(df))
    assert os.path.isdir(path)
