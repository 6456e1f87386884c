"""Invariants: counters add up, reordered input gives the same output, and the
flagship plan keeps its shape (pruned scan, partial top-1 before the shuffle, no Python)."""

from pyspark.sql import functions as F

from delaylens.operators import ingest
from delaylens.plans.catalog import load_all
from delaylens.plans.model_build import Models, raw_running_from_fixture
from delaylens.sources import fixtures

SMOKE = "/root/testdata/sf0.001"


def test_counters_add_up(spark):
    raw = fixtures.load(spark, SMOKE, "running_raw")
    checked = ingest.with_rule_check(raw)
    empty = spark.createDataFrame([], "source_record_hash string")
    c = ingest.load_counters(checked, empty).first()
    assert c.received == c.valid + c.rejected == raw.count()
    assert c.inserted == c.distinct_valid and c.already_present == 0
    again = ingest.load_counters(checked, raw_running_from_fixture(spark, SMOKE)).first()
    assert again.inserted == 0 and again.already_present == c.distinct_valid


def test_reordered_input_gives_same_marts(spark):
    accepted = raw_running_from_fixture(spark, SMOKE)
    shuffled = accepted.repartition(5, F.rand(7)).sortWithinPartitions(F.rand(11))
    a = Models(accepted)
    b = Models(shuffled)
    for name in ("mart_station_delay", "mart_train_punctuality"):
        assert sorted(getattr(a, name).collect()) == sorted(getattr(b, name).collect())
    cols = ["train_number", "journey_date", "station_code", "station_sequence",
            "previous_station_arrival_delay_minutes", "arrival_delay_minutes", "source_record_hash"]
    assert sorted(a.fact_station_arrival.select(cols).collect()) == \
        sorted(b.fact_station_arrival.select(cols).collect())


def test_flagship_plan_shape(spark):
    df = load_all()["station_delay"].build(spark, SMOKE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "WindowGroupLimit" in plan and plan.count("REPARTITION_BY_COL") == 1
    assert "PythonUDF" not in formatted and "BatchEvalPython" not in formatted
    read_schemas = [line for line in formatted.splitlines() if line.startswith("ReadSchema")]
    assert read_schemas and all("l_extendedprice" not in s and "l_comment" not in s for s in read_schemas)
