import datetime as dt

from tallyforge.streaming.refresh import distinct_rows, landing, refresh_totals, totals, windowed_counts

SCHEMA = "id bigint, k string, v bigint, ts timestamp"


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def test_totals_take_each_file_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    t = dt.datetime(2024, 1, 1)
    schema = spark.createDataFrame([], SCHEMA).schema
    for name, rows in (("a", [(1, "x", 5, t), (2, "y", 7, t)]), ("b", [(3, "x", 1, t)])):
        land(spark, src, name, rows)
        refresh_totals(landing(spark, f"{src}/*", schema), ["k"], "v", out, ck).awaitTermination()
    refresh_totals(landing(spark, f"{src}/*", schema), ["k"], "v", out, ck).awaitTermination()
    assert sorted(tuple(r) for r in totals(spark, out, ["k"]).collect()) == [("x", 6, 2), ("y", 7, 1)]


def test_windows_and_distinct(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(1, "x", 1, dt.datetime(2024, 1, 1, 5)), (1, "x", 1, dt.datetime(2024, 1, 1, 5)), (2, "x", 1, dt.datetime(2024, 1, 2, 5))]
    land(spark, src, "a", rows)
    schema = spark.createDataFrame([], SCHEMA).schema
    for name, make, want in (("w", lambda s: windowed_counts(s, "ts", "k"), 2), ("d", lambda s: distinct_rows(s, ["id"], "ts"), 2)):
        q = make(landing(spark, f"{src}/*", schema)).writeStream.format("memory").queryName(name).outputMode("complete" if name == "w" else "append").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(name).count() == want
