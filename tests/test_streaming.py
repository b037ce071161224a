import datetime as dt

from rodado.streaming import events as E

T0 = dt.datetime(2026, 1, 1, 8, 0)


def run(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(60)
        return df.sparkSession.table(name).collect()
    finally:
        q.stop()


def stream(spark, tmp_path, rows, schema):
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"{i}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path))


def test_windows_and_repeats(spark, tmp_path):
    ev = lambda i, m, k="a": (i, T0 + dt.timedelta(minutes=m), 1, k, 1.0)
    s = stream(spark, tmp_path, [[ev(1, 0), ev(2, 20), ev(2, 20)], [ev(3, 70)], [ev(4, 200)]], "event_id bigint, ts timestamp, user_id bigint, event_type string, value double")
    n = {(r["start"].hour, r["n"]) for r in run(E.windowed_counts(s), "w1")}
    assert (8, 3) in n
    assert sorted(r["event_id"] for r in run(E.once(s), "w2")) == [1, 2, 3, 4]
    assert any(r["n"] == 3 for r in run(E.sessions(s), "w3"))


def test_track_state(spark, tmp_path):
    s = stream(spark, tmp_path, [[(1, 0, 0.0, 0.0), (1, 1, 0.001, 0.0)], [(1, 2, 0.002, 0.0)]], "track bigint, ord bigint, lng double, lat double")
    rows = run(E.track_lengths(s, None), "w4", "update")
    assert max(r["points"] for r in rows) == 3 and abs(max(r["length_m"] for r in rows) - 222.39) < 0.1
