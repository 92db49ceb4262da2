"""Session helpers.

Library code never creates or reconfigures a session: plans take the caller's
``SparkSession``. ``local_session`` is for tests, the bench and scripts only.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins at runtime (a shuffle join
# becomes a broadcast only when the measured side is under the threshold) and
# splits skewed shuffle partitions; the rest pins dialect behaviour.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tiffin", extra: dict | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
