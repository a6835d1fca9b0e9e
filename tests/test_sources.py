import json

import pytest
from pyspark.sql import functions as F

from tanisight.schemas import schema
from tanisight.sources import jsonl, snapshots, tables
from tanisight.streaming import ingest
from tests.conftest import rows


def test_scan_skips_blank_and_broken_lines(spark, tmp_path):
    for day, body in (("2026-06-20", '{"a": 1, "n": {"x": 2.5}}\n\n   \nrusak\n'), ("2026-06-21", '{"a": 2}\n{"a": 3\n')):
        (tmp_path / "s" / day).mkdir(parents=True)
        (tmp_path / "s" / day / "batch_1.jsonl").write_text(body)
    good, bad = jsonl.scan(spark, str(tmp_path / "s"), schema(spark, "a int, n struct<x: double>"))
    assert rows(good.select("a", "n.x")) == [(1, 2.5), (2, None)]
    assert rows(bad) == [("rusak",), ('{"a": 3',)]
    assert good.count() == 2


def test_partitioned_write_defaults_the_day(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-06-20T01:00:00Z"), (2, None), (3, "")], "i int, fetched_at_utc string")
    jsonl.write_partitioned(df, str(tmp_path / "p"), "fetched_at_utc")
    back = spark.read.schema("i int, date string").json(str(tmp_path / "p"))
    assert rows(back) == [(1, "2026-06-20"), (2, "1970-01-01"), (3, "1970-01-01")]


def test_append_merges_schemas_and_missing_tables_are_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_table(spark, path, schema(spark, "a int")).count() == 0
    with pytest.raises(Exception):
        tables.read_table(spark, path)
    assert tables.write_table(spark.createDataFrame([(1,)], "a int"), path)
    assert tables.write_table(spark.createDataFrame([(2, "x")], "a int, b string"), path)
    assert not tables.write_table(spark.createDataFrame([], "a int"), path)
    assert rows(tables.read_table(spark, path), "a", "b") == [(1, None), (2, "x")]


def test_versions(spark, tmp_path):
    path = str(tmp_path / "v")
    assert snapshots.history(spark, path).count() == 0
    for i in range(3):
        assert snapshots.save_version(spark.range(i + 1), path, f"2026-01-0{i + 1} 00:00:00") == i
    assert rows(snapshots.history(spark, path), "version", "n_rows") == [(0, 1), (1, 2), (2, 3)]
    assert snapshots.read_version(spark, path, 1).count() == 2
    assert snapshots.read_version(spark, path).count() == 3
    with pytest.raises(ValueError):
        snapshots.read_version(spark, path, 7)


def test_reading_a_version_opens_no_others(spark, tmp_path):
    path = str(tmp_path / "v")
    for _ in range(2):
        snapshots.save_version(spark.range(3), path, "2026-01-01 00:00:00")
    files = snapshots.read_version(spark, path, 0).inputFiles()
    assert files and all("/_version=0/" in f for f in files)


def test_manifest_and_validation(spark):
    df = spark.createDataFrame([("k", "2026-01-01"), ("k", "2026-01-01"), ("k", "2026-01-03")], "key string, date string")
    got = rows(tables.ingest_manifest({"s": df}))
    assert ("s", "k", 3, "2026-01-01", "2026-01-03", 2) in got and got[0][0] == "TOTAL"
    report = tables.validate_layers({"x": (df, ["key", "date"]), "e": (df.limit(0), ["key"])})
    assert rows(report) == [("e", 0, 0, 0), ("x", 3, 0, 1)]


def _landing(tmp_path, parts):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, lines in enumerate(parts):
        (folder / f"{i}.txt").write_text("\n".join(lines) + "\n")
    return str(folder)


def _text_stream(spark, folder):
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    return lines.select(F.lit("news").alias("topic"), "value", F.lit("2026-06-20 01:00:00").cast("timestamp").alias("timestamp"))


def test_stream_decode_equals_batch_and_quarantines(spark, tmp_path):
    parts = [[json.dumps({"a": i}) for i in range(5)] + ["{rusak"], [json.dumps({"a": 9}), "x"]]
    stream = ingest.decode(_text_stream(spark, _landing(tmp_path, parts)), schema(spark, "a int"))
    out = str(tmp_path / "out")
    ingest.drain(ingest.split_bad(stream, out, ingest.DRAIN))
    assert [r[0] for r in rows(spark.read.parquet(f"{out}/good"), "a")] == [0, 1, 2, 3, 4, 9]
    assert rows(spark.read.parquet(f"{out}/quarantine"), "raw") == [("x",), ("{rusak",)]


def test_stream_restart_writes_nothing_twice(spark, tmp_path):
    folder = _landing(tmp_path, [[json.dumps({"a": i})] for i in range(3)])
    out = str(tmp_path / "out")
    for _ in range(2):
        decoded = ingest.decode(_text_stream(spark, folder), schema(spark, "a int"))
        ingest.drain(ingest.to_bronze(jsonl.good(decoded, "topic", "timestamp"), out, "timestamp", ingest.DRAIN))
    back = spark.read.parquet(f"{out}/data")
    assert back.count() == 3 and rows(back.select("topic", F.col("date").cast("string")).distinct()) == [("news", "2026-06-20")]


def test_stream_drops_repeated_ids_across_batches(spark, tmp_path):
    parts = [["a", "b", "a"], ["b", "c"], ["a"]]
    stream = _text_stream(spark, _landing(tmp_path, parts))
    out = str(tmp_path / "out")
    ingest.drain(ingest.append_to(ingest.drop_repeated(stream, "value", "timestamp", "1 day"), out, ingest.DRAIN))
    assert rows(spark.read.parquet(f"{out}/data"), "value") == [("a",), ("b",), ("c",)]


def test_versions_may_change_a_type_and_unfinished_saves_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.save_version(spark.createDataFrame([(1,)], "x long"), path, "2026-01-01 00:00:00")
    snapshots.save_version(spark.createDataFrame([("b",)], "x string"), path, "2026-01-02 00:00:00")
    spark.createDataFrame([(0.5,)], "x double").write.parquet(f"{path}/data/_version=2")
    assert rows(snapshots.read_version(spark, path, 0)) == [(1,)]
    assert rows(snapshots.read_version(spark, path)) == [("b",)]
    with pytest.raises(ValueError):
        snapshots.read_version(spark, path, 2)


def test_day_tables_keep_the_newest_batch_of_a_day(spark, tmp_path):
    from tanisight.sources import daytable
    import datetime as dt
    path, kind = str(tmp_path / "t"), schema(spark, "k string")
    d = [dt.date(2026, 1, i) for i in (1, 2, 3)] + [None]

    def put(batch, days, *new):
        more = spark.createDataFrame([(k, day) for k, day in new], "k string, date date")
        daytable.replace(spark, path, batch, days, kind, lambda old: old.unionByName(more))

    assert daytable.read(spark, path, kind).count() == 0 and daytable.next_batch(spark, path) == 0
    put(0, d, ("a", d[0]), ("b", d[1]), ("n", None))
    for _ in range(2):  # a repeated batch changes nothing
        put(1, d[:1], ("c", d[0]))
    want = sorted([("a", d[0]), ("c", d[0]), ("b", d[1]), ("n", None)], key=repr)
    assert rows(daytable.read(spark, path, kind)) == want
    assert rows(daytable.read(spark, path, kind, days=[d[1], None, d[2]])) == sorted([("b", d[1]), ("n", None)], key=repr)
    (tmp_path / "t" / "_batch=2" / "date=2026-01-01").mkdir(parents=True)  # a batch that never finished
    assert rows(daytable.read(spark, path, kind)) == want and daytable.next_batch(spark, path) == 2
    daytable.replace(spark, path, 2, d[:2], kind, lambda old: old.filter("k = 'c'"))  # the second day is empty now
    want = sorted([("c", d[0]), ("n", None)], key=repr)
    assert rows(daytable.read(spark, path, kind)) == want
    daytable.compact(spark, path)
    assert sorted(daytable.batches(spark, path)) == [0, 1, 2] and daytable.batches(spark, path)[1] == ["date=2026-01-01"]
    put(3, [d[2]], ("e", d[2]))
    daytable.compact(spark, path)
    kept = daytable.batches(spark, path)  # the third day of batch 0 stays: batch 3 can still be repeated
    assert sorted(kept) == [0, 2, 3] and sorted(kept[0]) == ["date=2026-01-03", "date=__HIVE_DEFAULT_PARTITION__"]
    assert rows(daytable.read(spark, path, kind)) == sorted([*want, ("e", d[2])], key=repr)
