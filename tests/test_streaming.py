"""Streams over several files, so that state has to carry over batches."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.streaming import jobs

START = dt.datetime(2024, 1, 1)


def write(spark, folder, batches):
    schema = "id int, user string, ts timestamp"
    for i, hours in enumerate(batches):
        data = [(i * 100 + k, u, START + dt.timedelta(hours=h)) for k, (u, h) in enumerate(hours)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return jobs.file_stream(spark, str(folder), schema, files_per_batch=1)


def finish(spark, stream, tmp_path, **options):
    path = str(tmp_path / "out")
    jobs.start(stream, path, str(tmp_path / "state"), **options).awaitTermination()
    return path


def test_cooldown_over_batches(spark, tmp_path):
    stream = write(spark, tmp_path / "in", [[("a", 0), ("a", 5), ("b", 3)], [("a", 23), ("a", 24), ("b", 30)]])
    path = finish(spark, jobs.cooldown(stream, "user"), tmp_path)
    got = sorted((r["key"], r["ts"].hour + 24 * (r["ts"].day - 1)) for r in jobs.stored(spark, path).collect())
    assert got == [("a", 0), ("a", 24), ("b", 3), ("b", 30)]


def test_daily_cap_over_batches(spark, tmp_path):
    stream = write(spark, tmp_path / "in", [[("a", 1)], [("b", 3), ("c", 2), ("d", 25)]])
    path = finish(spark, jobs.daily_cap(stream), tmp_path)
    got = sorted((r["key"].day, r["ts"].hour) for r in jobs.stored(spark, path).collect())
    assert got == [(1, 1), (1, 2), (2, 1)]


def test_daily_news_counts_once(spark, tmp_path):
    stream = write(spark, tmp_path / "in", [[("a", 1), ("a", 2)], [("a", 3), ("b", 4)]])
    path = finish(spark, jobs.daily_news(stream, ["user"]), tmp_path, mode="update")
    got = {r["user"]: r["n"] for r in jobs.stored(spark, path, ["day", "user"]).collect()}
    assert got == {"a": 3, "b": 1}


def test_refresh_loads_once_a_day(spark, tmp_path):
    stream = write(spark, tmp_path / "in", [[("a", 1)], [("b", 2)]])
    loads = []

    def load():
        loads.append(1)
        return spark.createDataFrame([("a", 7), ("b", 8)], "user string, rank int")

    path = str(tmp_path / "out")
    run = jobs.refresh(
        stream, load, lambda batch, table: batch.join(table, "user").select("user", "rank"), path, str(tmp_path / "state"), every=None
    )
    run.awaitTermination()
    assert {r["user"]: r["rank"] for r in jobs.stored(spark, path).collect()} == {"a": 7, "b": 8}
    assert len(loads) == 1


def test_late_rows_leave(spark, tmp_path):
    stream = write(spark, tmp_path / "in", [[("a", 1)], [("a", 80)], [("a", 81)], [("a", 2), ("a", 82)]])
    path = finish(spark, jobs.daily_news(stream, ["user"]), tmp_path, mode="update")
    total = jobs.stored(spark, path, ["day", "user"]).agg(F.sum("n")).first()[0]
    # A batch drops by the watermark known when the one before it began, hence the batch in between.
    assert total == 4  # the row two days behind the watermark is not counted
