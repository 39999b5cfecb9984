import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from gridlake.session import SESSION_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def registry(spark):
    from gridlake.sources.registry import seed_registry
    return seed_registry(spark)


def raw_frame(spark, texts, start="2025-11-17 06:00:00"):
    """Raw rows from payload texts: raw_id raw-<i>-0, received_at start + i minutes."""
    from datetime import datetime, timedelta
    t0 = datetime.fromisoformat(start)
    rows = [(f"raw-{i}-0", t, t0 + timedelta(minutes=i), "") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "raw_id string, payload string, received_at timestamp, source_ip string")
