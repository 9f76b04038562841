"""Session set-up."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "shelfline",
    master: str | None = None,
    object_store: dict[str, str] | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC time and adaptive execution.

    ``object_store`` takes ``endpoint``, ``access_key`` and ``secret_key`` of an
    S3-compatible store; table roots are then ``s3a://`` paths.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if object_store:
        settings = {
            "endpoint": object_store["endpoint"],
            "access.key": object_store["access_key"],
            "secret.key": object_store["secret_key"],
            "path.style.access": "true",
            "connection.ssl.enabled": str(object_store["endpoint"].startswith("https")).lower(),
        }
        for name, value in settings.items():
            builder = builder.config(f"spark.hadoop.fs.s3a.{name}", value)
    for name, value in (extra or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
