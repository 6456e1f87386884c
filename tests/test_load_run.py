"""Historical load job: audit-gated visibility, idempotent re-run, quarantine output."""

import os


from delaylens.plans import load_run
from delaylens.sources import files, fixtures

SMOKE = "/root/testdata/sf0.001"


def _paths(scratch):
    return load_run.LoadPaths(os.path.join(scratch, "raw"), os.path.join(scratch, "quarantine"),
                              os.path.join(scratch, "audit"))


def _inputs(spark, scratch):
    d, r = os.path.join(scratch, "delays"), os.path.join(scratch, "routes")
    files.write_csv(fixtures.load(spark, SMOKE, "delay_csv"), d)
    files.write_csv(fixtures.load(spark, SMOKE, "route_gaps"), r)
    return d, r


def test_rerun_inserts_nothing_and_quarantine_is_written(spark, scratch):
    d, r = _inputs(spark, scratch)
    paths = _paths(scratch)
    first = load_run.historical_load(spark, d, r, paths, run_id="a")
    second = load_run.historical_load(spark, d, r, paths, run_id="b")
    assert first["inserted"] == first["distinct_valid"] > 0
    assert second["inserted"] == 0 and second["already_present"] == first["distinct_valid"]
    assert first["received"] == first["valid"] + first["rejected"]
    q = spark.read.json(os.path.join(paths.quarantine_root, "run_id=a"))
    assert q.count() == first["rejected"] and "error_codes" in q.columns
    schema = load_run.read_raw(spark, paths, spark.read.parquet(os.path.join(paths.raw_root, "run_id=a")).schema).schema
    assert load_run.read_raw(spark, paths, schema).count() == first["distinct_valid"]


def test_rows_of_a_failed_run_stay_invisible(spark, scratch):
    d, r = _inputs(spark, scratch)
    paths = _paths(scratch)
    load_run.historical_load(spark, d, r, paths, run_id="ok")
    schema = spark.read.parquet(os.path.join(paths.raw_root, "run_id=ok")).schema
    visible = load_run.read_raw(spark, paths, schema).count()
    # A run that wrote rows but failed before its audit said "succeeded".
    some = load_run.read_raw(spark, paths, schema).limit(5)
    some.write.partitionBy("journey_date").parquet(os.path.join(paths.raw_root, "run_id=broken"))
    load_run.audit_event(spark, paths, "broken", "src", "running")
    load_run.audit_event(spark, paths, "broken", "src", "failed", error="boom")
    assert load_run.read_raw(spark, paths, schema).count() == visible
    audit = {row.run_id: row.status for row in load_run.read_audit(spark, paths.audit_root).collect()}
    assert audit == {"ok": "succeeded", "broken": "failed"}
