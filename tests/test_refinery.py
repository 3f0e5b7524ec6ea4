import pytest

from millrace.operators import lineage, quality, summary
from millrace.plans import refinery
from millrace.sources import buckets, tables
from tests.conftest import rows
from tests.samples import BAD, BRONZE, GOLD, UPDATES


@pytest.fixture
def layout(tmp_path):
    return refinery.Layout.under(str(tmp_path))


def events(spark, layout):
    log = lineage.read_events(spark, layout.events).orderBy("eventTime").collect()
    return [(e["job"]["name"], e["eventType"]) for e in log]


def test_sample_run(spark, orders, layout):
    results = refinery.run(spark, orders(BRONZE), layout, incoming=orders(UPDATES))
    assert results.count() == 5 and quality.passed(results)
    silver = rows(buckets.read(spark, layout.silver))
    assert silver == sorted([*UPDATES, *BRONZE[1:]], key=repr)
    gold = summary.by_revenue(tables.read_snapshot(spark, layout.gold)).collect()
    assert [tuple(r) for r in gold] == GOLD
    assert events(spark, layout) == [
        (name, state)
        for name in ("bronze_layer", "silver_layer", "quality_gate", "gold_layer")
        for state in ("START", "COMPLETE")
    ]
    report = {r["stage"]: r["rows_out"] for r in
              lineage.stage_report(lineage.read_events(spark, layout.events)).collect()}
    # Silver is seeded with 4 rows, then one is updated and one inserted.
    assert report == {
        "bronze_layer": 4, "silver_layer": 6, "quality_gate": None, "gold_layer": 5,
    }


def test_later_batches_are_merged(spark, orders, layout):
    refinery.run(spark, orders(BRONZE), layout)
    refinery.run(spark, orders(UPDATES), layout)
    assert rows(buckets.read(spark, layout.silver)) == sorted(
        [*UPDATES, *BRONZE[1:]], key=repr
    )
    bronze = tables.read_appended(spark, layout.bronze, orders([]).schema)
    assert rows(bronze) == sorted(BRONZE + UPDATES, key=repr)


def test_failed_gate_stops_before_gold(spark, orders, layout):
    refinery.run(spark, orders(BRONZE), layout)
    before = tables.current_snapshot(spark, layout.gold)
    with pytest.raises(quality.GateFailed, match=r"Unique\(order_id\).*Between\(price\)"):
        refinery.run(spark, orders(BAD), layout)
    assert tables.current_snapshot(spark, layout.gold) == before
    assert events(spark, layout)[-2:] == [("quality_gate", "START"), ("quality_gate", "FAIL")]


def test_rerun_before_the_seed_is_caught(spark, orders, layout):
    """Bronze keeps the same rows twice; Silver seeded from it fails the uniqueness check."""
    tables.add_batch(orders(BRONZE), layout.bronze, orders([]).schema)
    with pytest.raises(quality.GateFailed, match="Unique"):
        refinery.run(spark, orders(BRONZE), layout)
    # Every copy of a target row is updated by a merge.
    silver = rows(buckets.read(spark, layout.silver))
    assert silver == sorted(BRONZE * 2, key=repr)


def test_mismatched_batch_is_refused(spark, orders, layout):
    refinery.run(spark, orders(BRONZE), layout)
    bad = spark.createDataFrame([("ORD999", "x")], "order_id string, unexpected_column string")
    with pytest.raises(tables.SchemaMismatch):
        refinery.run(spark, bad, layout)
    assert events(spark, layout)[-2:] == [("bronze_layer", "START"), ("bronze_layer", "FAIL")]


def test_stage_events(spark, tmp_path):
    log = str(tmp_path / "events")
    with lineage.track_stage(spark, log, "good", namespace="n", producer="p") as stage:
        stage.observe(spark.range(7)).write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="expected"), lineage.track_stage(spark, log, "bad"):
        raise ValueError("expected")
    found = lineage.read_events(spark, log).orderBy("eventTime").collect()
    assert [(e["job"]["name"], e["eventType"], e["rows_out"]) for e in found] == [
        ("good", "START", None),
        ("good", "COMPLETE", 7),
        ("bad", "START", None),
        ("bad", "FAIL", None),
    ]
    assert found[0]["job"]["namespace"] == "n" and found[0]["producer"] == "p"
    assert found[0]["run"]["runId"] == found[1]["run"]["runId"] != found[2]["run"]["runId"]


def test_later_runs_merge_the_batch_and_what_else_comes(spark, orders, layout):
    refinery.run(spark, orders(BRONZE[:2]), layout)
    refinery.run(spark, orders(BRONZE[2:]), layout, incoming=orders(UPDATES))
    assert rows(buckets.read(spark, layout.silver)) == sorted([*UPDATES, *BRONZE[1:]], key=repr)
