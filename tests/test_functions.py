import pytest
from pyspark.sql import functions as F

from loamstack.functions import hashing as H
from loamstack.functions import probing as P
from loamstack.functions import scheduling, statistics
from loamstack.functions import scores as S


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, want", [(0.9, 0.9), (90.0, 0.9), (250.0, 1.0), (-1.0, 0.0)])
def test_confidence_is_brought_to_the_unit_range(spark, raw, want):
    assert one(spark, S.unit_confidence(F.col("v")), v=raw) == pytest.approx(want)


@pytest.mark.parametrize("seconds, want", [(1.9, 0.9), (2.0, 0.8), (4.9, 0.8), (5.0, 0.7), (30.0, 0.7), (30.1, 0.6)])
def test_feedback_confidence_by_response_time(spark, seconds, want):
    assert one(spark, S.feedback_confidence(F.col("t"), F.lit("engaged")), t=seconds) == pytest.approx(want)


def test_first_text_takes_the_first_visible_key(spark):
    assert one(spark, P.first_text(F.col("j"), ["a", "b", "c"]), j='{"a": "  ", "b": {"text": "deep"}, "c": "x"}') == "deep"


def test_versions_compare_by_number(spark):
    assert one(spark, H.semantic_version(F.lit("1.10.0")) > H.semantic_version(F.lit("1.9.3")))
    assert one(spark, H.next_version(F.lit("1.9.3"), "minor")) == "1.10.0"


def test_map_hash_ignores_the_order_of_entries(spark):
    a, b = F.create_map(F.lit("x"), F.lit("1"), F.lit("y"), F.lit("2")), F.create_map(F.lit("y"), F.lit("2"), F.lit("x"), F.lit("1"))
    assert one(spark, H.label_hash(a) == H.label_hash(b))


def test_percentiles_of_both_kinds(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 10)], "v double")
    row = df.agg(F.percentile("v", 0.95).alias("a"), statistics.index_percentile(F.col("v"), 0.5).alias("b"), statistics.lower_median(F.col("v")).alias("c")).first()
    assert row["a"] == pytest.approx(9.1) and row["b"] == 4.0 and row["c"] == 2.0


def test_trimmed_mean_of_ten_drops_one_at_each_end(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(1, 10), 100]], "v double")
    assert df.agg(statistics.trimmed_mean(F.col("v"), 0.2).alias("m")).first()["m"] == pytest.approx(5.5)


def test_cron_rules(spark):
    assert scheduling.parse_cron("*/15 8-10 * * 0,4")["minute"] == [0, 15, 30, 45]
    with pytest.raises(ValueError):
        scheduling.parse_cron("61 * * * *")
    runs = {r["rule"]: str(r["next"]) for r in scheduling.next_runs(spark, {"a": "30 2 * * *", "b": "0 0 1 * *"}, "2024-01-15 03:00:00", 40).collect()}
    assert runs == {"a": "2024-01-16 02:30:00", "b": "2024-02-01 00:00:00"}


def test_normal_p_value(spark):
    assert one(spark, statistics.normal_p_value(F.lit(1.959963985).cast("double"))) == pytest.approx(0.05, abs=1e-6)
