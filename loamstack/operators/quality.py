"""Filters on examples, with one reason for each rejected row, and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import content_hash, messages_hash
from ..functions.probing import strip


def filled(column: Column) -> Column:
    return F.coalesce(strip(column), F.lit("")) != ""


def has_content() -> Column:
    """By format: a user and an assistant message, an output, or a prompt and a chosen text; raw text never counts."""
    chat = F.exists("messages", lambda m: (m["role"] == "user") & filled(m["content"])) & F.exists("messages", lambda m: (m["role"] == "assistant") & filled(m["content"]))
    return (
        F.when(F.size("messages") > 0, chat).when(F.col("instruction").isNotNull(), filled(F.col("output_text")))
        .when(F.col("prompt").isNotNull(), filled(F.col("prompt")) & filled(F.col("chosen"))).otherwise(False)
    )


def example_hash() -> Column:
    return F.when(F.size("messages") > 0, messages_hash(F.col("messages"))).when(F.col("instruction").isNotNull(), content_hash(F.col("instruction"), F.col("input_text"), F.col("output_text"))).otherwise(content_hash(F.col("prompt"), F.col("chosen"), F.col("rejected")))


def reject_reason(min_tokens: int = 10, max_tokens: int = 4096, min_quality: float = 0.5, spare_corrections: bool = True) -> Column:
    """The first check that a row fails; null if it passes all."""
    spared = F.col("is_correction") if spare_corrections else F.lit(False)
    return (
        F.when(~has_content(), "no_content").when(F.col("estimated_tokens") < min_tokens, "too_short").when(F.col("estimated_tokens") > max_tokens, "too_long")
        .when((F.col("quality_score") < min_quality) & ~F.coalesce(spared, F.lit(False)), "below_quality")
    )


def judged(examples: DataFrame, *order: str, **limits) -> DataFrame:
    """``reject_reason`` for each example; of equal ones that pass, all but the first are duplicates."""
    rows = examples.select("*", F.inline(F.array(F.struct(reject_reason(**limits).alias("reject_reason"), example_hash().alias("content_hash")))))
    passed = rows.where("reject_reason IS NULL").withColumn("n", F.row_number().over(Window.partitionBy("content_hash").orderBy(*order)))
    passed = passed.withColumn("reject_reason", F.when(F.col("n") > 1, "duplicate")).drop("n")
    return passed.unionByName(rows.where("reject_reason IS NOT NULL"))


def filter_statistics(rows: DataFrame) -> DataFrame:
    n = F.count("*")
    passed = F.count_if(F.col("reject_reason").isNull())
    counts = [F.count_if(F.col("reject_reason") == r).alias(r) for r in ("no_content", "too_short", "too_long", "below_quality", "duplicate")]
    return rows.agg(n.alias("total"), passed.alias("passed"), (n - passed).alias("filtered"), *counts, F.round(F.try_divide(passed, n), 6).alias("pass_rate"))


def routed(scored: DataFrame, least: float = 7.0) -> DataFrame:
    """keep, improve or reject: by the judge's word or the score."""
    keep = (F.col("recommendation") == "keep") | (F.col("score") >= least)
    return scored.withColumn("route", F.when(keep, "keep").when(F.col("recommendation") == "improve", "improve").otherwise("reject"))


def parsed_scores(replies: DataFrame, text: str = "reply") -> DataFrame:
    """A judge's reply: scores out of ten (5 where missing) in the JSON between the first and last brace; no JSON scores 0 and is rejected."""
    body = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    parsed = F.try_parse_json(F.when(body != "", body))
    score = F.coalesce(F.try_variant_get(parsed, "$.overall_score", "double"), F.lit(5.0))
    said = F.try_variant_get(parsed, "$.recommendation", "string")
    word = F.coalesce(said, F.when(score >= 7, "keep").when(score >= 4, "improve").otherwise("reject"))
    return replies.withColumns({"score": F.when(parsed.isNull(), 0.0).otherwise(score), "recommendation": F.when(parsed.isNull(), "reject").otherwise(word)})


def score_statistics(scored: DataFrame) -> DataFrame:
    n = F.count("*")
    routes = [F.count_if(F.col("recommendation") == r).alias(r) for r in ("keep", "improve", "reject")]
    return scored.agg(n.alias("n"), F.round(F.avg("score"), 6).alias("mean_score"), F.min("score").alias("min_score"), F.max("score").alias("max_score"), *routes, F.round(F.try_divide(F.count_if(F.col("recommendation") == "keep"), n), 6).alias("keep_rate"))
