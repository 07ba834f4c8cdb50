"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Malformed input becomes NULL through try_* functions, so ANSI mode stays on.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesces small partitions, splits skewed join partitions,
    # and switches to a broadcast only once the measured size allows it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording a Python call site for every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Rerunning an ingest replaces the quarters it carries and leaves the others alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app_name: str = "filingstrata",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's defaults; ``extra`` overrides or adds settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
