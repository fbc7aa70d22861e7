"""Session defaults. Operators never depend on these; they only make runs comfortable."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app_name: str = "kpiloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Dimension tables of this size are looked up without shuffling the lines.
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
    if master and master.startswith("local"):
        defaults |= {
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("KPILOOM_DRIVER_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": "8",
        }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
