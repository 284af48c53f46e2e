"""The session settings that the library is tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, app: str = "tessera", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` adds or overrides settings (dots as double underscores)."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
