"""Tables that cut lineage do not leave the shuffle files of their write behind (findings of round 4, F1)."""

import os
import time

from pyspark.sql import functions as F

from gridlake.llm import common, jaccard_join
from gridlake.session import FREE_SHUFFLES


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {os.path.join(d, f) for top in dirs for d, _, names in os.walk(top.getPath())
            for f in names if f.startswith("shuffle_")}


def _gone(spark, files, seconds=20):
    end = time.time() + seconds
    while (left := files & _shuffle_files(spark)) and time.time() < end:
        time.sleep(0.2)
    return not left


def test_a_stored_table_frees_its_shuffles(spark):
    before, set_before = _shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    kept = spark.range(5000).withColumn("text", F.sha2(F.col("id").cast("string"), 256)).repartition(7, "text")
    table = common.stored(kept, "frees")
    assert _gone(spark, _shuffle_files(spark) - before)
    assert table.count() == 5000 and spark.conf.get(FREE_SHUFFLES, None) == set_before


def test_near_copies_hold_the_shuffles_of_one_table_at_a_time(spark, monkeypatch):
    """The keys, the texts and the tiles are not on disk together, and the rows are what they were."""
    real, left = jaccard_join.stored, []

    def watched(df, name, *more):
        before = _shuffle_files(spark)
        out = real(df, name, *more)
        left.append((name, _gone(spark, _shuffle_files(spark) - before)))
        return out
    monkeypatch.setattr(jaccard_join, "stored", watched)
    base = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t) for i, t in enumerate(base[:5])]
    rows += [(200 + i, t + " more") for i, t in enumerate(base[5:9])] + [(300, None)]
    out = jaccard_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), k=5, num=80, den=100, sample=2)
    assert sorted(r["doc_id"] for r in out.collect()) == [*range(20), 300]
    assert "jaccard-counts" in dict(left) and all(ok for _, ok in left), left
