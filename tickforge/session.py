"""Session settings that the engine relies on."""

from pyspark.sql import SparkSession


def session(app: str = "tickforge", **conf: str) -> SparkSession:
    """UTC time, ANSI arithmetic, adaptive plans with skew handling; ``conf`` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
