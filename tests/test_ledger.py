import datetime

import pytest
from pyspark.sql import functions as F

from lanelux.operators import ledger, sinks
from lanelux.schemas import FILE_LOG

READ_AT = datetime.datetime(2024, 5, 1, 12, 0)


def log(spark, *entries):
    """(oid, name, id, folder, series, conform, step, year)"""
    data = [(o, n, i, f, f and "m" + f, s, READ_AT, c, st, y) for o, n, i, f, s, c, st, y in entries]
    return spark.createDataFrame(data, FILE_LOG)


def test_new_files(spark, rows):
    known = log(
        spark,
        (1, "a.xls", "i1", "A", None, None, 3, 2024),
        (2, "b.xls", None, "B", None, None, 3, 2024),
        (3, "b.xls", "i3", "B", None, None, 3, 2024),
    )
    listing = log(
        spark,
        (0, "a.xls", "n1", "A", None, None, 0, 2024),
        (0, "a.xls", "n2", "A", None, None, 0, 2023),
        (0, "b.xls", "n3", "B", None, None, 0, 2024),
        (0, "c.xls", "n4", "Z", None, None, 0, 2024),
        (0, "c.xls", "n5", "C", None, None, 0, 2024),
    )
    got = ledger.new_files(listing, known, READ_AT)
    # c.xls twice in the listing: first path; b.xls: one logged row without id.
    assert rows(got.select("drive_file_name", "drive_file_id", "report_year")) == [
        ("a.xls", "n2", 2023),
        ("b.xls", "n3", 2024),
        ("c.xls", "n5", 2024),
    ]
    assert {(r["completed_step"], r["datetime_utc_read"]) for r in got.collect()} == {(3, READ_AT)}


def test_new_files_run_twice_adds_nothing(spark):
    listing = log(spark, *[(0, f"{n % 7}.xls", f"i{n}", f"f{n}", None, None, 0, 2024) for n in range(40)])
    first = ledger.new_files(listing, log(spark), READ_AT)
    assert first.count() == 7
    assert ledger.new_files(listing, first, READ_AT).count() == 0


@pytest.mark.parametrize(
    "path, seen",
    [("a/x.xls", True), ("x.xls", True), ("b/x.xls", False), ("archief/a/x.xls.oud.oud", False), ("", True), ("%", False)],
)
def test_new_paths(spark, path, seen):
    listing = spark.createDataFrame([(path,), ("nergens",)], "path string")
    logged = spark.createDataFrame([("archief/a/x.xls.oud",), ("y",), ("",), (None,)], "bestands_url string")
    left = [r["path"] for r in ledger.new_paths(listing, logged).collect()]
    assert (path not in left) is seen and "nergens" in left


def test_new_paths_equals_brute_force(spark):
    import random

    rnd = random.Random(3)

    def word(n):
        return "".join(rnd.choice("ab/") for _ in range(rnd.randint(1, n)))

    listing, logged = [word(6) for _ in range(150)], [word(12) for _ in range(40)]
    got = ledger.new_paths(
        spark.createDataFrame([(p,) for p in listing], "path string"),
        spark.createDataFrame([(p,) for p in logged], "bestands_url string"),
    )
    assert sorted(r["path"] for r in got.collect()) == sorted(p for p in listing if not any(p in s for s in logged))


def test_paths_with_one_tail_meet_few_texts(spark):
    """10,000 paths that differ only in front, and a log with as many of the same tail: pairs grow with the paths."""
    tail = "/Te_verwerken/2024/N0010001/N0010001 M1 met een lange naam.xls"
    listing = spark.range(10_000).select(F.concat(F.lit("map"), F.lpad(F.col("id").cast("string"), 7, "0"), F.lit(tail)).alias("path"))
    log = listing.where("path like '%1/Te%'").unionByName(
        spark.range(10_000).select(F.concat(F.lit("arch"), F.col("id").cast("string"), F.lit(tail)).alias("path"))
    )
    texts = log.select(F.xxhash64("path").alias("_id"), F.col("path").alias("_text"))
    assert ledger.path_candidates(listing, texts).count() <= 10_000
    assert ledger.new_paths(listing, log, logged="path").count() == 9_000


def test_an_empty_path_occurs_in_every_text(spark):
    listing = spark.createDataFrame([("",), ("a",), (None,)], "path string")
    log = spark.createDataFrame([("b",)], "bestands_url string")
    assert sorted(r["path"] or "" for r in ledger.new_paths(listing, log).collect()) == ["", "a"]  # the null one stays
    assert ledger.new_paths(listing, log.limit(0)).count() == 3


def test_new_paths_without_log_or_listing(spark):
    some, none = spark.createDataFrame([("a",)], "path string"), spark.createDataFrame([], "path string")
    assert ledger.new_paths(some, none.select(F.col("path").alias("bestands_url"))).count() == 1
    assert ledger.new_paths(none, some.select(F.col("path").alias("bestands_url"))).count() == 0


def test_queue_checks_and_transition(spark, rows):
    before = log(
        spark,
        (1, "A M1.xls", "i1", "A", "A M1", None, 3, 2024),
        (2, "B M1.xls", "i2", "A", "B M1", None, 3, 2024),
        (3, "C M1.xls", "i3", "C", None, None, 3, 2024),
        (4, "D M1.xls", "i4", "D", "D M1", None, 3, 2023),
        (5, "E M1.xls", "i5", "E", "E M1", True, 4, 2024),
    )
    queue = ledger.work_queue(before, 2024)
    assert rows(queue.select("oid")) == [(1,), (2,), (3,)]
    after = ledger.apply_checks(before, ledger.check_names(queue))
    assert rows(after.select("oid", "name_conform", "completed_step")) == [
        (1, True, 4),
        (2, False, 4),
        (3, False, 4),
        (4, None, 3),
        (5, True, 4),
    ]
    assert after.columns == before.columns
    assert ledger.work_queue(after, 2024).count() == 0


def test_ingest_log(spark, rows):
    known = log(
        spark,
        (1, "A M1.xls", "i1", "A", "A M1", True, 4, 2024),
        (2, "B M1.xls", "i2", "B", "B M1", None, 4, 2024),
        (3, "C M1.xls", "i3", "C", "C M1", True, 3, 2024),
        (4, "D M1.xls", "i4", "D", None, False, 4, 2024),
    )
    got = ledger.ingest_log(known, 2024)
    first = got.orderBy("oid").first()
    assert (first["bestands_url"], first["map_bestand"], first["bestandsnaam"]) == ("temp/A M1.xls", "\\A\\A M1.xls", "A\\A M1")
    assert rows(ledger.conform_files(got)) == [("temp/A M1.xls",)]
    assert rows(ledger.nonconform_files(got)) == [("temp/B M1.xls",), ("temp/D M1.xls",)]
    assert ledger.nonconform_count(got).first()["n"] == 2
    assert got.where("oid = 4").first()["bestandsnaam"] is None


def test_purges(spark, rows):
    ingest = spark.createDataFrame(
        [(1, "a", "x NIET y"), (2, "b", "goed"), (3, "c", None), (4, "a", "goed")],
        "oid long, bestands_url string, ctr_header_bestandsnaam string",
    )
    raw = spark.createDataFrame([(i, u) for i, u in enumerate(["a", "a", "b", "c", "d", None])], "oid long, bestands_url string")
    for limits in ({}, {"broadcast_rows": 0, "rows_per_task": 1}):
        if limits:
            limits["broadcast_rows"] = 0
            limits["rows_per_task"] = 1_000
        kept = ledger.purge_nonconform_measurements(raw, ingest, **limits)
        assert rows(kept.select("oid")) == [(2,), (3,), (4,), (5,)]
        assert ledger.purge_nonconform_measurements(kept, ingest, **limits).count() == 4
    assert rows(ledger.purge_nonconform_log(ingest).select("oid")) == [(2,), (3,), (4,)]


def test_measurements_with_status_repeat_per_log_row(spark, rows):
    ingest = spark.createDataFrame([("a", "OK"), ("a", "OK"), ("b", "fout")], "bestands_url string, ctr_header_bestandsnaam string")
    raw = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "oid long, bestands_url string")
    got = ledger.measurements_with_status(raw, ingest, "OK")
    assert rows(got) == [("a", 1), ("a", 1)] or rows(got.select("oid", "bestands_url")) == [(1, "a"), (1, "a")]


def test_backlog(spark):
    some = spark.range(5)
    assert ledger.backlog_count(some, spark.range(2)).first()["n"] == 3
    assert ledger.backlog_count(some.limit(0), some.limit(0)).first()["n"] == 0


def stamped(spark, *days):
    return spark.createDataFrame([(d, d and datetime.datetime(2024, 1, d)) for d in days], "id int, inleesdatum timestamp_ntz")


def test_newer_rows(spark, rows):
    source = stamped(spark, 1, 2, 3, None)
    assert rows(ledger.newer_rows(source, stamped(spark, 1, 2)).select("id")) == [(3,)]
    assert ledger.newer_rows(source, stamped(spark)).count() == 4
    assert ledger.newer_rows(source, stamped(spark, None)).count() == 4
    assert ledger.newer_rows(source, source).count() == 0


def test_rows_with_the_stamp_of_the_watermark(spark, rows):
    """Two runs with one stamp lose no row, and none is taken twice."""
    source = stamped(spark, 1, 2, 2, 2, 3, None).withColumn("key", F.monotonically_increasing_id())
    stored = source.where("id = 1").union(source.where("id = 2").limit(1))
    newer = ledger.newer_rows(source, stored, key=["key"])
    assert sorted(r["id"] for r in newer.collect()) == [2, 2, 3]
    assert newer.join(stored, "key").count() == 0
    twice = stored.union(newer)
    assert ledger.newer_rows(source.where("id is not null"), twice, key=["key"]).count() == 0
    assert ledger.newer_rows(source, source.limit(0), key=["key"]).count() == 6
    plan = newer._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    stamped(spark, 1, 2, 3).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = ledger.newer_rows(stored, stamped(spark, 1))._jdf.queryExecution().executedPlan().toString()
    assert "inleesdatum" in plan and "subquery" in plan.lower()


# --- sinks ------------------------------------------------------------------


def test_refresh_replaces_one_year(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.refresh(spark.range(3), path, 2023)
    sinks.refresh(spark.range(5), path, 2024)
    sinks.refresh(spark.range(1), path, 2024)
    got = sinks.read_table(spark, path).groupBy("report_year").count()
    assert rows(got) == [(2023, 3), (2024, 1)]
    sinks.refresh(spark.range(0), path, 2024)
    assert rows(sinks.read_table(spark, path).groupBy("report_year").count()) == [(2023, 3)]
    assert sinks.read_year(spark, path, 2024).columns == ["id"] and sinks.read_year(spark, path, 2022) is None


def test_a_year_is_read_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    for year in (2023, 2024):
        sinks.append_year(spark.range(3), path, year)
        sinks.append_year(spark.range(4), path, year)
    scan = sinks.read_table(spark, path).where("report_year = 2024")
    assert scan.count() == 7
    assert "PartitionFilters: [isnotnull(report_year" in scan._jdf.queryExecution().executedPlan().toString()


class Killed(Exception):
    pass


#: What a refresh calls, in order; each is where it may be killed.
STEPS = ["write", "_point", "_clear", "remove"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_readers_see_old_or_new_rows_at_every_step(spark, tmp_path, monkeypatch, step, after):
    path = str(tmp_path / "t")
    sinks.refresh(spark.range(2), path, 2024)
    sinks.append_year(spark.range(1), path, 2024)
    began = sinks.read_year(spark, path, 2024)  # a reader that goes on reading
    seen = []

    def look():
        n = sinks.read_year(spark, path, 2024).count()
        seen.append(n)
        assert n == sinks.read_table(spark, path).count() and n in (3, 5)

    def watched(name, call, kills):
        def run(*args, **options):
            look()
            if kills and not after:
                raise Killed
            call(*args, **options)
            look()
            if kills:
                raise Killed

        return run

    from pyspark.sql import DataFrameWriter

    with monkeypatch.context() as m:
        for name in ("_point", "_clear", "remove"):
            m.setattr(sinks, name, watched(name, getattr(sinks, name), name == step))
        m.setattr(DataFrameWriter, "parquet", watched("write", DataFrameWriter.parquet, step == "write"))
        rows = sinks.read_year(spark, path, 2024).select("id").union(spark.range(2))  # reads what it replaces
        try:
            sinks.refresh(rows, path, 2024)
        except Killed:
            pass
    assert seen == sorted(seen)  # never back to the old rows
    done = STEPS.index(step) > 1 or (step == "_point" and after)
    look()
    assert seen[-1] == (5 if done else 3)
    assert began.count() == 3
    sinks.refresh(spark.range(7), path, 2024)
    assert sinks.read_year(spark, path, 2024).count() == 7
    sinks.refresh(spark.range(8), path, 2024)
    assert len(list((tmp_path / "t" / "versions" / "report_year=2024").iterdir())) == 2  # nothing is left of the killed one


def test_killed_append_adds_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.append_year(spark.range(2), path, 2024)

    def killed(*args):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(sinks, "_point", killed)
        with pytest.raises(Killed):
            sinks.append_year(spark.range(5), path, 2024)
    assert sinks.read_year(spark, path, 2024).count() == 2


def test_create_append_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_if_absent(spark.range(3), path)
    sinks.create_if_absent(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    sinks.append(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5
    empty = str(tmp_path / "leeg")
    sinks.create_empty(spark.range(3), empty)
    assert spark.read.parquet(empty).count() == 0 and spark.read.parquet(empty).columns == ["id"]


def test_combined_csv(spark, tmp_path, rows):
    path = str(tmp_path / "c")
    sinks.write_combined_csv(spark.createDataFrame([("a", None), ("b", "0,5")], "x string, `Speed km/h` string"), path)
    back = spark.read.option("sep", ";").option("header", True).csv(path)
    assert rows(back) == [("a", None), ("b", "0,5")] and back.columns == ["x", "Speed km/h"]


def test_export_reports(spark, tmp_path):
    geom = spark.range(2).select("id", F.struct(F.lit(1.5).alias("x"), F.lit(2.0).alias("y")).alias("geoml72"))
    places = sinks.export_reports({"punten": geom, "leeg": spark.range(0)}, str(tmp_path))
    assert sorted(places) == ["leeg", "punten"]
    back = spark.read.option("sep", ";").option("header", True).csv(places["punten"])
    assert back.count() == 2 and back.columns == ["id", "geoml72"]
