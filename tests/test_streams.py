"""Streams: resumed and repeated micro-batches, keep-first by sessions; the dump reader."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from habiflow import sources as SRC
from habiflow import streaming as ST


def test_a_repeated_micro_batch_adds_nothing(spark, tmp_path):
    landing, sink, ckpt = (str(tmp_path / n) for n in ("landing", "sink", "ckpt"))
    enrich = lambda d: d.withColumn("v", d["id"] * 2)
    calls = []

    def run():
        s = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(landing)
        ST.append_batches(s, lambda d: (calls.append(1), enrich(d))[1], ["id"], sink, ckpt)
        return sorted((r["id"], r["v"]) for r in spark.read.parquet(sink).select("id", "v").collect())

    spark.range(0, 6, 1, 2).write.parquet(landing)
    assert run() == [(i, 2 * i) for i in range(6)]
    spark.range(4, 9, 1, 1).write.mode("append").parquet(landing)  # 4 and 5 come again
    assert run() == [(i, 2 * i) for i in range(9)]
    # as if the driver had died after writing the last batch and before committing it
    commits = sorted(int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit())
    for n in (f"{commits[-1]}", f".{commits[-1]}.crc"):
        if os.path.exists(f"{ckpt}/commits/{n}"):
            os.remove(f"{ckpt}/commits/{n}")
    before = len(calls)
    assert run() == [(i, 2 * i) for i in range(9)] and len(calls) == before + 1


def test_keep_first_of_differing_rows_by_order_not_by_arrival(spark, tmp_path):
    t = lambda d, h=0: dt.datetime(2020, 1, d, h)
    rows = [(1, 9, "late", t(1)), (1, 2, "first", t(2)), (1, 5, "middle", t(1, 12)), (2, 1, "only", t(3)), (None, 4, "b", t(5)),
            (None, 3, "a", t(5)), (1, 7, "far away", t(20)), (3, 8, "no time", None)]
    landing, sink, ckpt = (str(tmp_path / n) for n in ("landing", "sink", "ckpt"))
    df = spark.createDataFrame(rows, "id int, ord int, v string, at timestamp")
    for r in rows:
        spark.createDataFrame([r], df.schema).coalesce(1).write.mode("append").parquet(landing)
    ST.close_landing(df, landing, "at", "90 days")
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 100).parquet(landing)
    ST.run_available_now(ST.dedup_stream(s, "id", "at", "ord", "2 days"), sink, ckpt)
    got = sorted((str(r["id"]), r["ord"], r["v"]) for r in spark.read.parquet(sink).collect())
    assert got == [("1", 2, "first"), ("1", 7, "far away"), ("2", 1, "only"), ("None", 3, "a")]


def test_dump_reader_sets_malformed_lines_apart(spark, tmp_path):
    path = str(tmp_path / "dump")
    names = ("gbifID", "eventDate", "countryCode", "county", "decimalLatitude")
    lines = ["1\t2010-05-03\tUS\tA \"quoted\" county\t45.5", "2\t\tUS\t\tn/a", "3\t2010", "4\ta\tb\tc\t1.0\textra", ""]
    SRC.write_dump(spark.createDataFrame([(x,) for x in lines], "value string"), names, path, files=3)
    good, bad = SRC.read_dump(spark, path)
    assert sorted((r["gbifID"], r["county"], r["decimalLatitude"]) for r in good.collect()) == [
        (1, 'A "quoted" county', 45.5), (2, None, None)]
    assert sorted(r[0] for r in bad.collect()) == ["3\t2010", "4\ta\tb\tc\t1.0\textra"]
    with pytest.raises(ValueError, match="locality"):
        SRC.read_dump(spark, path, required=("gbifID", "locality"))
    assert good.filter(F.col("gbifID") == 1).select("gbifID").count() == 1
