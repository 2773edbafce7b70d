"""Extension points: row functions with retries, stages by name, injected teachers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import parsed_scores


def mapped(df: DataFrame, function: Callable, inputs: list[str], output: str, kind: str = "string", retries: int = 0) -> DataFrame:
    """``function`` over each row's inputs; its error's text in ``<output>_error`` after the last try."""
    schema = T.StructType([*df.schema.fields, *df.sparkSession.createDataFrame([], f"`{output}` {kind}, `{output}_error` string").schema.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            values, errors = [], []
            for args in zip(*[rows[c] for c in inputs]):
                value, error = None, None
                for _ in range(retries + 1):
                    try:
                        value, error = function(*args), None
                        break
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"
                values.append(value)
                errors.append(error)
            yield rows.assign(**{output: values, f"{output}_error": errors})

    return df.mapInPandas(run, schema)


def dead_letters(mapped_rows: DataFrame, output: str) -> DataFrame:
    return mapped_rows.where(F.col(f"{output}_error").isNotNull())


def retried(letters: DataFrame, function: Callable, inputs: list[str], output: str, kind: str = "string", most: int = 3) -> DataFrame:
    """Stored dead letters once more: ``retry_count`` grows, and those that fail ``most`` times are given up."""
    rows = letters.withColumn("retry_count", F.coalesce("retry_count", F.lit(0)) + 1) if "retry_count" in letters.columns else letters.withColumn("retry_count", F.lit(1))
    again = mapped(rows.drop(output, f"{output}_error"), function, inputs, output, kind)
    failed = F.col(f"{output}_error").isNotNull()
    return again.withColumn("state", F.when(~failed, "done").when(F.col("retry_count") >= most, "given_up").otherwise("waiting"))


def rewritten(df: DataFrame, teacher: Callable[[str], str], text: str, rounds: int = 1, good_enough: Callable[[str], bool] | None = None) -> DataFrame:
    """A teacher's rewrite of a text, repeated until it is good enough."""

    def improve(value: str) -> str:
        for _ in range(rounds):
            if good_enough is not None and good_enough(value):
                break
            value = teacher(value)
        return value

    return mapped(df, improve, [text], "rewritten")


def scored(df: DataFrame, teacher: Callable[[str], str], text: str, retries: int = 0) -> DataFrame:
    """A teacher's reply on each text, with the score and recommendation in it; a reply without any is rejected."""
    return parsed_scores(mapped(df, teacher, [text], "reply", retries=retries))


class Stages:
    """Named steps from a frame to a frame, in order; steps can be replaced, skipped or stopped after."""

    def __init__(self, **steps: Callable[[DataFrame], DataFrame]):
        self.steps = dict(steps)

    def register(self, name: str, step: Callable[[DataFrame], DataFrame]) -> None:
        self.steps[name] = step

    def run(self, df: DataFrame, skip: tuple[str, ...] = (), stop_after: str | None = None) -> DataFrame:
        for name, step in self.steps.items():
            if name not in skip:
                df = df.transform(step)
            if name == stop_after:
                break
        return df
