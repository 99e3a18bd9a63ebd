"""Exact and sketched profiles, and profiles that follow a growing folder."""

import pytest
from pyspark.sql import functions as F

from lexigrain.operators import validation


def table(spark, first, last):
    n = F.col("id")
    return spark.range(first, last).select(
        n.alias("a"), (n % 1000).alias("b"), F.when(n % 4 > 0, n.cast("string")).alias("c"), F.lit(None).cast("double").alias("d"), (n % 2 == 0).alias("e")
    )


def profile_of(frame):
    return {r.column_name: (r.data_type, r.null_count, round(r.null_pct, 6), r.distinct_count) for r in frame.collect()}


def test_exact_profile(spark):
    found = profile_of(validation.schema_profile(table(spark, 0, 8000)))
    assert found == {
        "a": ("bigint", 0, 0.0, 8000), "b": ("bigint", 0, 0.0, 1000), "c": ("string", 2000, 25.0, 6000),
        "d": ("double", 8000, 100.0, 0), "e": ("boolean", 0, 0.0, 2),
    }
    assert [row[1:] for row in profile_of(validation.schema_profile(table(spark, 0, 0))).values()] == [(0, 0.0, 0)] * 5


def assert_close(found, exact):
    for name, row in exact.items():
        assert found[name][:3] == row[:3] and found[name][3] == pytest.approx(row[3], rel=0.02)


def test_sketches_are_within_two_per_cent(spark):
    frame = table(spark, 0, 60_000)
    assert_close(profile_of(validation.schema_profile(frame, approximate=True)), profile_of(validation.schema_profile(frame)))


def test_profile_follows_a_folder(spark, tmp_path, monkeypatch):
    folder, store = str(tmp_path / "data"), str(tmp_path / "sketches")
    table(spark, 0, 9000).coalesce(3).write.parquet(folder)
    assert_close(profile_of(validation.update_profile(spark.read.parquet(folder), store)), profile_of(validation.schema_profile(table(spark, 0, 9000))))
    table(spark, 5000, 20_000).coalesce(1).write.mode("append").parquet(folder)

    scanned = []
    plain = validation.column_sketches
    monkeypatch.setattr(validation, "column_sketches", lambda frame, by=(): scanned.append(frame.count()) or plain(frame, by))
    both = table(spark, 0, 9000).unionAll(table(spark, 5000, 20_000))
    found = profile_of(validation.update_profile(spark.read.parquet(folder), store))
    assert scanned == [15_000]  # the new file only
    assert_close(found, profile_of(validation.schema_profile(both)))
    assert profile_of(validation.update_profile(spark.read.parquet(folder), store)) == found and len(scanned) == 1
