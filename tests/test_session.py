"""The checkpoint-folder rule: read from the session, never invented on a
cluster; scratch tables live under it and round-trip."""

from pyspark.sql import functions as F

from tabforge.session import ensure_checkpoint_dir, scratch_dir
from tabforge.sources import files as IO


def test_checkpoint_dir_comes_from_the_session(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    base = conf.rstrip("/") if conf else None
    path = scratch_dir(spark, "unit_stage")
    assert path.endswith("/tabforge/unit_stage")
    if base:
        assert path.startswith(base)


def test_stage_table_round_trip_and_materialize_reuse(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("g"))
    staged = IO.stage_table(df.groupBy("g").count(), scratch_dir(spark, "unit_stage"))
    assert staged.agg(F.sum("count")).first()[0] == 100
    calls = []

    def build():
        calls.append(1)
        return df
    path = scratch_dir(spark, "unit_materialize")
    IO.materialize(spark, path, build, expected_rows=-1)        # stale -> rebuilt
    again = IO.materialize(spark, path, build, expected_rows=100)
    assert again.count() == 100 and len(calls) == 1


def test_changed_values_of_equal_count_are_seen(spark, tmp_path):
    src = f"{tmp_path}/src"
    spark.range(5).write.parquet(src)
    build = lambda: spark.read.parquet(src).agg({"id": "sum"}).toDF("s")
    one = IO.materialize(spark, f"{tmp_path}/copy", build, fingerprint=IO.source_fingerprint(spark.read.parquet(src)))
    assert one.first()["s"] == 10
    spark.range(10, 15).write.mode("overwrite").parquet(src)
    two = IO.materialize(spark, f"{tmp_path}/copy", build, fingerprint=IO.source_fingerprint(spark.read.parquet(src)))
    assert two.first()["s"] == 60 and one.first()["s"] == 10
