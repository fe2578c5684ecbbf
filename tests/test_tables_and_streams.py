import os

import pytest
from pyspark.sql import functions as F

from turnstone import session
from turnstone.sources import tables as io
from turnstone.sources.versions import VersionedTable
from turnstone.streaming import boards


def test_csv_round_trip_keeps_the_schema(frame, tmp_path):
    df = frame([(1, "a,b", 2.5), (2, None, None)], "i bigint, s string, v double")
    back = io.read_csv(df.sparkSession, io.write_csv(df, str(tmp_path / "c")), "i BIGINT, s STRING, v DOUBLE")
    assert sorted(map(tuple, back.collect())) == [(1, "a,b", 2.5), (2, None, None)]


def test_upsert_replaces_keys_and_keeps_repeats(frame):
    now, staged = frame([(1, "old"), (2, "old")], "k int, v string"), frame([(2, "new"), (2, "new"), (3, "new")], "k int, v string")
    assert sorted(map(tuple, io.upsert(now, staged, ["k"]).collect())) == [(1, "old"), (2, "new"), (2, "new"), (3, "new")]


def test_publish_and_bound_parameters(frame):
    df = frame([(1, 2.0), (2, 3.0)], "k int, v double")
    table = VersionedTable(df.sparkSession, session.run_folder(df.sparkSession, "t"))
    table.publish(df, lambda s: s.withColumn("w", F.col("v") * 2))
    assert sorted(r["w"] for r in table.read().collect()) == [4.0, 6.0]
    assert io.run_sql(df.sparkSession, "SELECT k FROM {d} WHERE v > :floor", {"d": df}, floor=2.5).first()["k"] == 2


def test_versions_outlive_failures_and_old_ones_go(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "table"))
    with pytest.raises(ValueError):
        table.read()
    one = table.publish(spark.range(3))
    pinned = table.read()
    with pytest.raises(Exception, match="no_such_column"):
        table.publish(spark.range(9), lambda s: s.select("no_such_column"))
    with pytest.raises(Exception):  # fails while it writes
        table.publish(spark.range(9), lambda s: s.select(F.raise_error(F.lit("stop")).alias("x")))
    assert table.versions() == [one] and table.read().count() == 3
    two = table.publish(spark.range(5))
    assert table.versions() == [one, two] and table.read().count() == 5 and pinned.count() == table.read(one).count() == 3
    three = table.publish(table.read().union(spark.range(1)))  # from the version before
    assert table.versions() == [two, three] and table.read().count() == 6
    assert sorted(os.listdir(tmp_path / "table" / "data")) == [f"{two:012d}", f"{three:012d}"] and not os.listdir(tmp_path / "table" / "staging")
    with pytest.raises(ValueError):
        table.read(one)
    other = VersionedTable(spark, str(tmp_path / "table"))
    assert other._claim() == three + 1 and table._claim() == three + 2  # two writers never share a number


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    a = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    left = io.write_bucketed(a, "bucketed_left", ["k"], 4, str(tmp_path / "l"))
    right = io.write_bucketed(a.withColumnRenamed("v", "w"), "bucketed_right", ["k"], 4, str(tmp_path / "r"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right, "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.shared_folder(spark) == configured
    assert session.run_folder(spark, "x") != session.run_folder(spark, "x")


def test_stream_over_several_batches_equals_the_batch_answer(spark, tmp_path):
    src = str(tmp_path / "sales.parquet")
    rows = spark.range(600).select(
        (F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 97)).cast("timestamp_ntz").alias("ts"), (F.col("id") % 3).alias("kind"), F.lit(1.5).alias("v"))
    rows.repartitionByRange(6, "ts").sortWithinPartitions("ts").write.parquet(src)
    for i, name in enumerate(sorted(n for n in os.listdir(src) if n.endswith(".parquet"))):
        os.utime(f"{src}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(src)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "2 hours")
    windows = boards.windowed_counts(stream, "ts", "1 hour", ["kind"], [F.count("*").alias("n"), F.sum("v").alias("s")])
    got = {(r["window_start"], r["kind"]): (r["n"], r["s"]) for r in boards.run_to_table(windows, ["kind"], "test").collect()}
    want = rows.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("w"), "kind").agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    assert got == {(r["w"], r["kind"]): (r["n"], r["s"]) for r in want.collect()}


def test_trailing_hour_over_batches_late_rows_and_a_retry(spark, tmp_path):
    src, start = str(tmp_path / "events.parquet"), 1_700_000_040
    rows = [(start + 47 * i, "ab"[i % 3 == 0], float(i % 5)) for i in range(500)]
    late = [(start + 10, "a", 100.0)] * 3
    for number, part in enumerate([rows[:200], rows[200:350], rows[350:] + late]):
        frame = spark.createDataFrame(part, "at long, kind string, v double").select(F.timestamp_seconds("at").cast("timestamp_ntz").alias("ts"), "kind", "v")
        frame.coalesce(1).write.mode("append").parquet(src)
        new = max((f"{src}/{n}" for n in os.listdir(src) if n.endswith(".parquet")), key=os.path.getmtime)
        os.utime(new, (1_700_000_000 + number, 1_700_000_000 + number))
    sales = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(src)
    sales = sales.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "10 minutes")
    minutes = boards.minute_sales(sales, "ts", "kind", "v")
    log, dropped = boards.run_to_log(minutes, "minutes", "kind")
    assert dropped.agg(F.sum("late")).first()[0] >= 1  # three rows of one minute and kind are one row after the first sums
    hours = boards.trailing_hour(boards.follow_log(spark, log, minutes.schema, files=1), "kind")
    got = {(r.kind, int(r.minute.timestamp())): (r.sales, r.revenue) for r in boards.read_log(spark, boards.run_to_log(hours, "hours", "kind")[0], hours.schema).collect()}
    end = max(at for at, _, _ in rows) - 600
    want = {}
    for at, kind, _ in rows:
        minute = at - at % 60
        if minute + 60 <= end:
            inside = [v for t, k, v in rows if k == kind and minute - 59 * 60 <= t < minute + 60]
            want[kind, minute] = (len(inside), sum(inside))
    assert got == want and len(want) > 300
