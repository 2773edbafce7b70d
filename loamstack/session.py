"""Session settings that the operators assume: UTC, ANSI casts, adaptive plans."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "loamstack", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
