import os

from pyspark.sql import functions as F

from gridcube.streaming import ingest as ING
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    src = os.path.join(tmpdir_path, "landing")
    # two arrivals, with one event delivered twice
    ev.where("event_id % 2 = 0").write.mode("append").parquet(src)
    ev.where("event_id % 2 = 1 OR event_id = 0").write.mode("append").parquet(src)
    out, ckpt = os.path.join(tmpdir_path, "table"), os.path.join(tmpdir_path, "_ckpt")
    ING.ingest_stream(spark, src, ev.schema, out, ckpt, "ts", "events", glob="*.parquet",
                      max_files_per_trigger=1)
    streamed = ING.read_ingested(spark, out)
    assert spark.read.parquet(out).select("batch_id").distinct().count() > 1   # several micro-batches
    batch = ING.ingest_batch(ev, "ts", "events")
    assert streamed.count() == batch.count() == ev.count()
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0
    # a rerun with the same checkpoint finds nothing new
    ING.ingest_stream(spark, src, ev.schema, out, ckpt, "ts", "events", glob="*.parquet")
    assert ING.read_ingested(spark, out).count() == ev.count()
    assert set(r.month for r in streamed.select("month").distinct().collect()) == \
        set(r.m for r in ev.select(F.date_format("ts", "yyyy-MM").alias("m")).distinct().collect())


def test_replayed_batch_is_not_duplicated(spark, tmpdir_path):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = os.path.join(tmpdir_path, "table")
    rows = ING.clean_batch(ev, "ts", "events")
    ING.write_batch(rows.where("event_id < 5"), 0, out)
    ING.write_batch(rows.where("event_id >= 5"), 1, out)
    ING.write_batch(rows.where("event_id >= 5"), 1, out)      # replay of batch 1
    stored = spark.read.parquet(out)
    assert stored.count() == ev.count()
    assert stored.where("batch_id = 0").count() == 5


def _events(spark, rows):
    df = spark.createDataFrame(rows, "id long, day string, v string")
    return df.select("id", F.to_timestamp("day").alias("ts"), "v", F.substring("day", 1, 7).alias("month"))


def _day():
    return F.dayofmonth("ts")


def test_replay_late_rows_and_null_months(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    first = [(i, f"2025-11-{1 + i % 9:02d}", "a") for i in range(30)] + [(99, None, "x")]
    ING.write_batch(_events(spark, first), 0, path, _day())
    ING.write_batch(_events(spark, first), 0, path, _day())                       # the same batch again
    late = first[:7] + [(99, None, "x")] + [(i, "2025-11-03", "b") for i in range(5)] + [(1, "2025-12-01", "a"), (50, None, None)]
    ING.write_batch(_events(spark, late), 1, path, _day())
    ING.write_batch(_events(spark, late), 1, path, _day())
    ING.write_batch(_events(spark, first + late), 2, path, _day())                # nothing new
    got = list((r.id, str(r.ts)[:10], r.v, r.month) for r in ING.read_ingested(spark, path).collect())
    want = {(i, d or "None", v, d and d[:7]) for i, d, v in first + late}
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_a_batch_reads_the_history_of_its_days_only(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    for b in range(6):                                                           # a month that grows, two days a batch
        rows = [(1000 * b + i, f"2025-11-{1 + 2 * b + i % 2:02d}", "a") for i in range(200)]
        ING.write_batch(_events(spark, rows), b, path, _day())
    batch = ING._hashed(_events(spark, [(5, "2025-11-02", "a"), (1, "2025-11-02", "a"), (7777, "2025-11-30", "z")]), ["id", "ts", "v", "month"], _day())
    found, files = ING.earlier_batches(batch, 6, path)
    assert found == [("2025-11", 0)]
    assert files and all("month=2025-11/slot=2/" in f for f in files)
    _, none = ING.earlier_batches(batch.where("id = 7777"), 6, path)
    assert none == []


def test_a_table_without_history_gets_one(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    rows = [(i, "2025-11-05", "a") for i in range(10)]
    _events(spark, rows).withColumn("batch_id", F.lit(3)).write.partitionBy("month", "batch_id").parquet(path)
    ING.write_batch(_events(spark, rows + [(11, "2025-11-06", "a")]), 4, path)
    assert ING.read_ingested(spark, path).count() == 11
    assert spark.read.parquet(path).where("batch_id = 4").count() == 1
