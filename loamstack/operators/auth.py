"""Analytics of authentication results and automation events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scores as S

FACTORS = ("ml_confidence", "physics_confidence", "behavioral_confidence", "visual_confidence", "final_confidence")


def metrics(results: DataFrame) -> DataFrame:
    """One row of rates, mean confidences, counts and risk; an empty window has rate and confidence 0."""
    rate = lambda c: F.coalesce(F.avg(c.cast("int")) * 100, F.lit(0.0))
    row = results.agg(
        F.count("*").alias("total"), F.count_if("authenticated").alias("successful"), rate(F.col("authenticated")).alias("success_rate"),
        *[F.coalesce(F.avg(F.coalesce(c, F.lit(0.0))), F.lit(0.0)).alias(f"avg_{c}") for c in FACTORS],
        F.count_if("spoofing_detected").alias("spoofing"), F.count_if("visual_threat_detected").alias("visual_threats"), F.count_if(~F.coalesce("liveness_passed", F.lit(True))).alias("liveness_failures"),
        F.coalesce(F.avg("execution_time_ms"), F.lit(0.0)).alias("avg_ms"), rate(F.col("analysis_mode_used") == "fast_path").alias("fast_path_rate"),
        F.avg(F.when(F.size("reasoning_chain") > 0, F.size("reasoning_chain"))).alias("avg_chain"),
    )
    args = [F.col(c) for c in ("success_rate", "spoofing", "visual_threats", "liveness_failures", "avg_final_confidence")]
    return row.withColumns({"risk": S.risk_level(S.risk_points(*args)), "risk_factors": S.risk_factors(*args)})


def top_hypotheses(results: DataFrame, k: int = 5) -> DataFrame:
    return results.select(F.explode("hypotheses_evaluated").alias("hypothesis")).groupBy("hypothesis").count().orderBy(F.desc("count"), "hypothesis").limit(k)


def confidence_breakdown(results: DataFrame) -> DataFrame:
    long = results.unpivot(["request_id"], list(FACTORS), "factor", "confidence").where("confidence IS NOT NULL")
    return long.groupBy("factor").agg(F.avg("confidence").alias("mean"), F.min("confidence").alias("low"), F.max("confidence").alias("high"), F.coalesce(F.stddev_samp("confidence"), F.lit(0.0)).alias("sd"))


def threats(results: DataFrame) -> DataFrame:
    """Alerts by rules over the window: three spoofs, any visual threat, or ten results of which more than half failed."""
    row = results.agg(
        F.count("*").alias("n"), F.count_if("spoofing_detected").alias("spoofs"), F.count_if("visual_threat_detected").alias("visual"), F.count_if(~F.coalesce("authenticated", F.lit(False))).alias("failed")
    )
    rules = F.array_compact(F.array(
        F.when(F.col("spoofs") >= 3, F.struct(F.lit("spoofing").alias("threat"), F.lit("high").alias("severity"), F.col("spoofs").alias("count"))),
        F.when(F.col("visual") > 0, F.struct(F.lit("visual").alias("threat"), F.lit("critical").alias("severity"), F.col("visual").alias("count"))),
        F.when((F.col("n") >= 10) & (F.col("failed") / F.col("n") > 0.5), F.struct(F.lit("failures").alias("threat"), F.lit("moderate").alias("severity"), F.col("failed").alias("count"))),
    ))
    return row.select(F.explode(rules).alias("r")).select("r.*")


def automation(events: DataFrame) -> DataFrame:
    """Mean batch size, savings and use of the parser of automation events."""
    batches = F.count_if(F.col("batch_size") > 1)
    return events.agg(
        F.count("*").alias("events"), batches.alias("batches"), F.try_divide(F.sum(F.when(F.col("batch_size") > 1, F.col("batch_size"))), batches).alias("avg_batch"),
        F.sum("time_saved_ms").alias("time_saved_ms"), F.sum("tokens_saved").alias("tokens_saved"), F.coalesce(F.avg(F.col("assisted").cast("int")) * 100, F.lit(0.0)).alias("assisted_percent"),
    )


def modes(events: DataFrame, column: str = "parser_mode") -> DataFrame:
    return events.groupBy(F.coalesce(column, F.lit("unknown")).alias("mode")).count()
