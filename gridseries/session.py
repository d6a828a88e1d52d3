"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "gridseries", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` adds settings (dots as double underscores)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
