from pyspark.sql import functions as F

from entry_queries import views as v


def test_ordered_files_read_the_input_twice_and_keep_every_row_in_its_range(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(number):
        read.add(1)
        return number

    seen = F.udf(counted, "long").asNondeterministic()
    rows = spark.range(600).select(
        seen("id").alias("id"), F.timestamp_seconds(F.col("id") * 60).alias("ts")
    )
    files = v.as_ordered_files(spark, rows, "ts")
    assert read.value <= 2 * 600  # once for the ranges' bounds, once for the rows: not once per range

    written = spark.read.parquet(files.path).select("id", "ts", F.col("_metadata.file_path").alias("file"))
    assert sorted(r["id"] for r in written.collect()) == list(range(600))
    spans = written.groupBy("file").agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    times = written.select("file", F.col("_metadata.file_modification_time").alias("at")).distinct()
    ordered = spans.join(times, "file").orderBy("at", "file").collect()
    batches = [ordered[i : i + files.max_files] for i in range(0, len(ordered), files.max_files)]
    assert len(batches) == 6
    assert all(max(r["high"] for r in a) < min(r["low"] for r in b) for a, b in zip(batches, batches[1:]))
