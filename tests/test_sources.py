import json

import pytest
from pyspark.sql import functions as F

from phonoloom.operators import slots
from phonoloom.sources import jsonl, sinks
from phonoloom.sources.archive import ArchiveSource
from phonoloom.streaming import incremental


def test_jsonl_lines_and_errors(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text("\n".join(json.dumps({"id": f"x{i}", "n": i}) for i in range(50)) + "\n\n")
    rows = jsonl.read_jsonl(spark, str(p), "id string, n long", ("id",))
    got = rows.orderBy("line_no").collect()
    assert [(r.line_no, r.n) for r in got] == [(i + 1, i) for i in range(50)]
    assert [r.n for r in jsonl.first_lines(rows, 3).collect()] == [0, 1, 2]
    for bad in ("{torn", "[1]", '{"n": 3}', '{"id": ""}'):
        q = tmp_path / "b.jsonl"
        q.write_text('{"id": "a"}\n' + bad + "\n")
        with pytest.raises(ValueError, match="b.jsonl:2"):
            jsonl.read_jsonl(spark, str(q), "id string, n long", ("id",))
        assert [r.id for r in jsonl.done_ids(spark, str(q)).collect()] == ["a"]
    assert jsonl.done_ids(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_line_numbers_across_splits(spark, tmp_path):
    p = tmp_path / "big.jsonl"
    p.write_text("".join(json.dumps({"id": str(i), "pad": "x" * (i % 90)}) + "\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = jsonl.read_jsonl(spark, str(p), "id string")
        assert spark.read.text(str(p)).rdd.getNumPartitions() > 1
        assert rows.where(F.col("line_no") != F.col("id").cast("long") + 1).count() == 0 and rows.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_archive_members(spark, tmp_path):
    a = tmp_path / "a.tar"
    a.write_bytes(b"0123456789")
    (tmp_path / "a.tar.idx").write_text("two\t4\t3\none\t0\t4\nbroken\t1\n")
    spark.dataSource.register(ArchiveSource)
    rows = spark.read.format("archive_members").option("paths", str(a)).load().collect()
    assert [(r.member, bytes(r.data)) for r in rows] == [("one", b"0123"), ("two", b"456")]
    assert sorted(r.member for r in jsonl.archive_index(spark, str(a) + ".idx").collect()) == ["one", "two"]


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    sinks.replace_table(df, p)
    sinks.replace_table(spark.read.parquet(p).where("id = 2"), p)
    assert [r.id for r in spark.read.parquet(p).collect()] == [2]
    assert sinks.guarded_append(spark.createDataFrame([(3, "c")], df.schema), p, "id") == 1
    for rows in ([(3, "x")], [(4, "x"), (4, "y")]):
        with pytest.raises(ValueError):
            sinks.guarded_append(spark.createDataFrame(rows, df.schema), p, "id")
    assert spark.read.parquet(p).count() == 2
    assert sinks.fingerprint(df) == sinks.fingerprint(df.orderBy(F.desc("id"))) != sinks.fingerprint(df.where("id = 1"))
    assert sinks.fingerprint(df.where("id > 5")).startswith("0-")


def test_slots(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    got = slots.apply_slot(df, slots.Slot("quality", "stub", (("seed", 3),)), "x", "q").collect()
    assert [r.q is None for r in got] == [False, True, False]
    with pytest.raises(ValueError):
        slots.resolve(slots.Slot("quality", "stub", (("other", 1),)))
    with pytest.raises(ValueError):
        slots.resolve(slots.Slot("asr", "none"))


def test_follow_and_batches(spark, tmp_path):
    src, sink, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    spark.createDataFrame([("a", 1), ("b", 2)], "id string, n long").write.parquet(src)
    incremental.follow(spark, src, "id string, n long", "id", sink, cp)
    spark.createDataFrame([("b", 2), ("c", 3)], "id string, n long").write.mode("append").parquet(src)
    incremental.follow(spark, src, "id string, n long", "id", sink, cp)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]
    u = spark.createDataFrame([(i, 4) for i in range(6)], "k long, n long")
    assert [r.batch for r in incremental.assigned_batches(u, "k", "n", 10).orderBy("k").collect()] == [0, 0, 0, 1, 1, 2]
    beats = spark.createDataFrame([("k", "a", 1.0), ("k", "b", 5.0), ("l", "a", 0.0)], "key string, owner string, ts double")
    assert [(r.key, r.owner) for r in incremental.live_keys(beats, 10.0, 6.0).collect()] == [("k", "b")]


def test_streamed_windows_equal_batch(spark, tmp_path):
    from phonoloom.operators.sequences import gap_windows

    rows = [("r", i, t, t + 1500) for i, t in enumerate([0, 2000, 20_000, 21_000, 60_000, 61_000, 63_000])] + [("q", 9, 5_000, 9_000)]
    ends = [("r", 100, 900_000, 900_500), ("q", 101, 900_000, 900_500)]
    src = tmp_path / "in"
    schema = "sid string, idx long, s long, e long"
    for n, part in enumerate((rows[:3], rows[3:], ends)):
        spark.createDataFrame(part, schema).withColumn("at", F.timestamp_millis("e")).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(schema + ", at timestamp").option("maxFilesPerTrigger", 1).parquet(str(src))
    q = incremental.streamed_gap_windows(stream).writeStream.format("memory").queryName("win").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.sid, r.win_start, r.win_end, r.n_seg) for r in spark.table("win").collect()}
    batch = gap_windows(spark.createDataFrame(rows, schema)).groupBy("sid", "win").agg(F.max("e").alias("x"), F.count("*").alias("n")).collect()
    assert got == {(r.sid, r.win, r.x, r.n) for r in batch}
