"""Incremental folder conversion: each file converted exactly once."""

from blotter.streaming import convert_csv_folder


def test_conversion_resumes_and_never_duplicates(spark, tmp_path):
    src, dst, ckpt = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    (src / "a.csv").write_text("k,v\n1,x\n2,y\n")
    (src / "notes.txt").write_text("k,v\n9,ignored\n")
    schema = "k int, v string"

    convert_csv_folder(spark, str(src), str(dst), schema, checkpoint=str(ckpt)).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(dst)).collect()) == [1, 2]

    (src / "b.csv").write_text("k,v\n3,z\n")
    convert_csv_folder(spark, str(src), str(dst), schema, checkpoint=str(ckpt)).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(dst)).collect()) == [1, 2, 3]

    # a third run with nothing new adds nothing
    convert_csv_folder(spark, str(src), str(dst), schema, checkpoint=str(ckpt)).awaitTermination()
    assert spark.read.parquet(str(dst)).count() == 3


def test_default_checkpoint_resumes(spark, tmp_path):
    src, dst = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.csv").write_text("k,v\n1,x\n2,y\n")
    convert_csv_folder(spark, str(src), str(dst), "k int, v string").awaitTermination()
    (src / "b.csv").write_text("k,v\n3,z\n4,w\n5,u\n")
    convert_csv_folder(spark, str(src), str(dst), "k int, v string").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(dst)).collect()) == [1, 2, 3, 4, 5]


def test_part_of_day_counts_run_on_a_file_stream(spark):
    """The batch operators compose on a streaming DataFrame (complete mode)."""
    import uuid

    from blotter.operators import code_filter
    from blotter.plans.part_of_day import EVENTS_CSV_DDL, NULL_EVERY, part_of_day_counts
    from blotter.plans.standins import events_csv
    from tests.conftest import SF01

    paths = events_csv(spark, SF01, NULL_EVERY)
    batch = {r.part_day: r.n for r in part_of_day_counts(
        code_filter(spark.read.schema(EVENTS_CSV_DDL).option("header", True).csv(paths), "event_type", "purchase"),
        "TIME OCC").collect()}
    stream = spark.readStream.schema(EVENTS_CSV_DDL).option("header", True).csv(paths[0].rsplit("/", 1)[0])
    counts = part_of_day_counts(code_filter(stream, "event_type", "purchase"), "TIME OCC")
    name = f"pod_{uuid.uuid4().hex[:8]}"
    query = counts.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    streamed = {r.part_day: r.n for r in spark.table(name).collect()}
    assert streamed == batch


def test_conversion_in_bounded_batches(spark, tmp_path):
    src, dst, ckpt = tmp_path / "in", tmp_path / "out", tmp_path / "ckpt"
    src.mkdir()
    for i in range(3):
        (src / f"f{i}.csv").write_text(f"k,v\n{i},x\n{i + 10},y\n")
    query = convert_csv_folder(spark, str(src), str(dst), "k int, v string", checkpoint=str(ckpt),
                               max_files_per_trigger=1)
    query.awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(dst)).collect()) == [0, 1, 2, 10, 11, 12]
    assert len(query.recentProgress) >= 3  # one file per micro-batch


def _arrivals(spark, src, batches):
    for rows in batches:
        spark.createDataFrame(rows, "k string, ts timestamp").write.mode("append").parquet(src)
        yield


def test_windows_on_a_stream_are_those_of_the_batch(spark, tmp_path):
    """Shuffled arrival within the delay, a restart before every arrival, NULL
    times, a restart without new rows, and one row that is too late."""
    import datetime as dt
    import random

    from blotter.streaming.windows import append_to, sessions, windowed

    start, rnd = dt.datetime(2024, 3, 1), random.Random(1)
    rows = [("ab"[k % 2], start + dt.timedelta(minutes=rnd.randrange(60 * 48))) for k in range(300)]
    rows.sort(key=lambda r: r[1] + dt.timedelta(hours=rnd.uniform(0, 5)))
    last = ("a", start + dt.timedelta(days=30))  # moves the watermark past all of them
    late = ("a", start + dt.timedelta(minutes=5))
    batches = [rows[:100], rows[100:200] + [(None, None)], rows[200:], [last], [late, last]]
    everything = spark.createDataFrame(rows, "k string, ts timestamp")
    for n, (shape, closed) in enumerate([
            (lambda s: windowed(s, "ts", "6 hours", None, "6 hours", ["k"]), "n"),
            (lambda s: windowed(s, "ts", "6 hours", "2 hours", "6 hours", ["k"]), "n"),
            (lambda s: sessions(s, "ts", "40 minutes", "6 hours", ["k"]), "n")]):
        src, out = str(tmp_path / f"in{n}"), str(tmp_path / f"out{n}")
        stream = None
        for _ in _arrivals(spark, src, batches):
            stream = stream or spark.readStream.schema("k string, ts timestamp").parquet(src)
            append_to(shape(stream), out).awaitTermination()
        append_to(shape(stream), out).awaitTermination()
        got = sorted(map(tuple, spark.read.parquet(out).collect()))
        assert got == sorted(map(tuple, shape(everything).collect()))
        assert sum(r[-1] for r in got if n != 1) in (0, len(rows))
