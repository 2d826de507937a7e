from conftest import DATA
from pyspark.sql import functions as F

from wavetide.streaming import daily


def test_new_files_are_cut_once(spark, tmp_path):
    traces = spark.read.parquet(f"{DATA}/sf0.001/traces.parquet").select("trace_id", "station", "data")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        daily.cut_new_traces(spark, source, traces.schema, lambda b: b.select("trace_id", F.size("data").alias("n")), target, str(tmp_path / "state")).awaitTermination(60)

    half = traces.filter("trace_id % 2 = 0")
    half.write.parquet(source)
    run()
    assert spark.read.parquet(target).count() == half.count()
    traces.filter("trace_id % 2 = 1").write.mode("append").parquet(source)
    run()
    run()
    out = spark.read.parquet(target)
    assert out.count() == out.select("trace_id").distinct().count() == traces.count()


def test_pending(spark):
    asked = spark.createDataFrame([("A", "1", 1), ("A", "2", 2), ("B", "1", 3)], "station string, day string, k int")
    done = spark.createDataFrame([("A", "1"), ("A", "1")], "station string, day string")
    assert sorted(r.k for r in daily.pending(asked, done).collect()) == [2, 3]


def test_days_without_windows_are_marked_too(spark, tmp_path):
    asked = spark.createDataFrame([("A", "1", 1), ("A", "2", 2), ("B", "1", 3)], "station string, day string, k int")
    daily.mark_done(asked.filter("k = 1"), str(tmp_path / "done"))
    daily.mark_done(asked.filter("k = 3"), str(tmp_path / "done"))
    assert [r.k for r in daily.pending(asked, spark.read.parquet(str(tmp_path / "done"))).collect()] == [2]


def test_arrivals_in_a_stream_equal_those_of_a_table(spark, tmp_path):
    path = f"{DATA}/sf0.001"
    table = spark.read.parquet(f"{path}/traces.parquet")
    want = daily.arrivals(table).count()
    stream = daily.arrivals(spark.readStream.schema(table.schema).option("pathGlobFilter", "traces.parquet").parquet(path))
    stream.writeStream.format("memory").queryName("arrived").outputMode("complete").trigger(availableNow=True).start().awaitTermination(60)
    assert spark.table("arrived").count() == want > 0
