import datetime
import itertools
import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from lanelux.operators import shares
from lanelux.plans import adapters as given
from lanelux.plans import reports
from lanelux.plans.pipeline import run_year
from lanelux.schemas import CLASS_COLUMNS, PROVINCES

CLS = ["A", "B", "C", "D"]


@pytest.fixture(scope="module")
def wegcat(spark):
    rnd = random.Random(4)
    data = []
    for i in range(800):
        data.append(
            (
                i,
                f"N00{i % 30:04d}{rnd.choice('12')}",
                datetime.datetime(rnd.choice([2023, 2024]), 3, 1),
                rnd.choice(["M1", "M1", "M1R", "M2", "M3", None]),
                rnd.choice([0, None, *range(1, 260, 7)]),
                rnd.choice([*PROVINCES.values(), None]),
                rnd.choice(["H", "P1", "P2", "S", None]),
            )
        )
    base = spark.createDataFrame(
        data,
        "oid long, ident8 string, tijdstip_meting timestamp_ntz, markering string, rl int, provincie string, wegcategorie string",
    )
    others = [c for c in shares.CLASSIFIED_COLUMNS if c not in base.columns and c not in [*CLASS_COLUMNS, "offset_1000"]]
    return base.withColumns({c: F.lit(None).cast("string") for c in others}).cache()


def klass(rl, primary):
    limits = [79, 119, 179, 9999] if primary else [49, 99, 199, 9999]
    return next(c for c, top in zip(CLS, limits) if rl <= top)


def expected(wegcat, report):
    """The share report written as plain loops over the rows."""
    kept = []
    for r in wegcat.collect():
        if not r["rl"]:
            continue
        if report.category and not (r["wegcategorie"] or "").startswith(report.category):
            continue
        if report.marking and not (r["markering"] or "").startswith(report.marking):
            continue
        if report.area == "provincie" and r["provincie"] is None:
            continue
        area = r["provincie"] if report.area == "provincie" else "Vlaanderen"
        marked = r["markering"] if report.marking else ("M1_M2" if report.area == "gebied" else None)
        kept.append((r["tijdstip_meting"].year, marked, area, klass(r["rl"], report.category == "P")))
    total = Counter(k[2] for k in kept)
    out = set()
    for key, n in Counter(kept).items():
        share = (Decimal(n) * 100 / total[key[2]]).quantize(Decimal("0.1"), ROUND_HALF_UP)
        out.add((*key, float(share)))
    return out


@pytest.mark.parametrize("name", list(reports.SHARE_REPORTS))
def test_share_report_equals_plain_loops(spark, wegcat, name):
    report = reports.SHARE_REPORTS[name]
    got = reports.share_report(
        shares.reading_counts(wegcat), given.classes(spark), given.classes_p(spark), report, ordered=True
    )
    assert got.columns == reports.share_columns(report)
    marked = "markering" in got.columns
    found = [
        (r["jaar"], r["markering"] if marked else None, r[report.area], r["klasse"], r["percentage_metingen"])
        for r in got.collect()
    ]
    assert len(found) == len(set(found)) and set(found) == expected(wegcat, report)


def test_shares_of_an_area_add_up(spark, wegcat):
    counted = shares.classify_counts(shares.reading_counts(wegcat), given.classes(spark))
    got = shares.class_share(counted, "provincie")
    sums = got.groupBy("provincie").agg(F.sum("percentage_metingen").alias("p"), F.count("*").alias("n"))
    for r in sums.collect():
        assert abs(r["p"] - 100) <= 0.05 * r["n"] + 1e-9


def test_counted_classes_equal_row_classes(spark, wegcat, rows):
    by_row = shares.classify(wegcat, given.classes_p(spark), "P")
    grouped = by_row.groupBy(F.year("tijdstip_meting").alias("jaar"), "markering", "provincie", *CLASS_COLUMNS).agg(F.count("rl").alias("n"))
    counted = shares.classify_counts(shares.reading_counts(wegcat), given.classes_p(spark), "P")
    assert rows(shares.class_counts(counted, ["jaar", "markering", "provincie"])) == rows(grouped)


@pytest.mark.parametrize("n, total", [(1, 3), (1, 8), (1, 16), (1, 2000), (1999, 2000), (1, 1), (5 * 10**11, 10**12 + 1)])
def test_percentage_is_exact(spark, n, total):
    got = spark.range(1).select(shares.percentage(F.lit(n).cast("bigint"), F.lit(total).cast("bigint"))).first()[0]
    assert got == float((Decimal(n) * 100 / total).quantize(Decimal("0.1"), ROUND_HALF_UP))


def test_every_report_is_there():
    assert len(reports.REPORTS) == 19
    combos = {(r.category, r.area, r.marking) for r in reports.SHARE_REPORTS.values()}
    assert len(combos) == 15
    every = set(itertools.product([None, "H", "P"], ["provincie", "gebied"], [None, "M1", "M2"]))
    assert combos == {c for c in every if c[0] or c[1] == "provincie"}


def test_run_year(spark, tmp_path, monkeypatch):
    from lanelux.plans import pipeline
    from tests.test_survey import HEAD, body, keyed, write

    read_paths = []

    def scan(session, paths, *args, **options):
        read_paths.append(sorted(p.rsplit("/", 1)[-1] for p in paths))
        return scan_files(session, paths, *args, **options)

    scan_files = pipeline.scan_files
    monkeypatch.setattr(pipeline, "scan_files", scan)

    source = tmp_path / "Te_verwerken"

    def series(n):
        return {**HEAD, "Measure Series Name:": n}

    write(source / "N0010001" / "N0010001 M1.xls", keyed(body(f0="1,0"), body(f0="10,0"), body(f0="99,0"), body(f2="veel"), head=series("N0010001 M1")))
    write(source / "N0010002" / "N0010002 M1.xls", keyed(body(f1="03/04/2023 05:06:07"), body(f2="0"), head=series("N0010002 M1")))
    write(source / "elders" / "N0010003 M1.xls", keyed(body(), head=series("N0010003 M1")))
    write(source / "N0010004" / "N0010004 M1.xls", ["Info:\tx", body()])
    empty = [""] * 24
    segments = []
    for n, (road, begin, end) in enumerate([("N0010001", 0, 10), ("N0010001", 10, 20), ("N0010002", 0, 10), ("N0010003", 0, 10)]):
        row = list(empty)
        row[0:3] = ["9", str(n), road]
        row[5], row[8], row[9], row[10], row[21] = str(begin), str(end), "Regio D11142", "true", "H1"
        segments.append("\t".join(row))
    (tmp_path / "segmenten.tsv").write_text("\n".join(["\t".join(f"h{i}" for i in range(24)), *segments]) + "\n")

    read_at = datetime.datetime(2024, 6, 1)
    tables = run_year(
        spark, str(source), str(tmp_path / "segmenten.tsv"), given.classes(spark), given.classes_p(spark),
        str(tmp_path / "uit"), 2024, read_at,
    )
    log = {r["drive_file_name"]: (r["name_conform"], r["completed_step"]) for r in tables["file_log"].collect()}
    assert log.pop("N0010004 M1.xls") == (False, 4)
    told = {r["drive_file_name"]: r["outcome"] for r in tables["file_outcome"].collect()}
    assert told.pop("N0010004 M1.xls") == "no header end" and set(told.values()) == {"ok"} and len(told) == 3
    assert tables["ingest_log"].count() == 4
    assert log == {"N0010001 M1.xls": (True, 4), "N0010002 M1.xls": (True, 4), "N0010003 M1.xls": (False, 4)}
    assert tables["measurement_raw"].count() == 5 and tables["measurement_rejected"].count() == 1
    assert tables["measurement_point"].count() == 4
    # Position 10.0 lies on two segments, 99.0 on none.
    assert tables["per_district_wegcat"].where("ident8 = 'N0010001'").count() == 3
    got = [tuple(r) for r in tables["procent_per_prov_vl_H"].select("jaar", "percentage_metingen", "markering", "gebied", "klasse").collect()]
    assert got == [(2024, 100.0, "M1_M2", "Vlaanderen", "C")]
    assert set(reports.REPORTS) <= set(tables)
    again = run_year(
        spark, str(source), str(tmp_path / "segmenten.tsv"), given.classes(spark), given.classes_p(spark),
        str(tmp_path / "uit"), 2024, read_at,
    )
    assert again["per_district_wegcat"].count() == 4
    assert read_paths == [["N0010001 M1.xls", "N0010002 M1.xls", "N0010003 M1.xls", "N0010004 M1.xls"]]
    lines = again["measurement_line"].count()
    write(source / "N0010005" / "N0010005 {M1}.xls", keyed(body(), body(f12="4,2", f13="50,6"), head=series("N0010005 {M1}")))
    # A refresh broken off before its last step has left a folder that nothing names.
    left = tmp_path / "uit" / "measurement_point" / "versions" / "report_year=2024" / "version=left"
    left.mkdir()
    (left / "part-0.parquet").write_bytes(b"half")
    third = run_year(
        spark, str(source), str(tmp_path / "segmenten.tsv"), given.classes(spark), given.classes_p(spark),
        str(tmp_path / "uit"), 2024, datetime.datetime(2024, 7, 1),
    )
    assert read_paths[1:] == [["N0010005 {M1}.xls"]]
    assert third["measurement_raw"].count() == 7 and third["measurement_raw"].select("bestands_url", "line_no").distinct().count() == 7
    assert third["measurement_line"].count() == lines + 1
    exported = spark.read.option("sep", ";").option("header", True).csv(str(tmp_path / "uit" / "export" / "2024" / "procent_per_prov_vl_H"))
    assert [r["klasse"] for r in exported.collect()] == ["C"]
    assert not left.exists()


def test_located_points_are_kept_up_to_date(spark, tmp_path, rows, monkeypatch):
    """Files come, go and come again: counts equal those of all points, only new files are located, a broken-off run is mended."""
    from lanelux.plans import located
    from lanelux.plans.pipeline import Store

    roads = [(f"N00{k}0001", k) for k in range(1, 6)]
    read = [(100 * k + n, f"f{k % 4}", road, float(n % 12), "M1", n % 7, datetime.datetime(2024, 1, 1 + k)) for road, k in roads for n in range(40)]
    points = spark.createDataFrame(read, "oid long, bestands_url string, ident8 string, kmp double, markering string, rl int, tijdstip_meting timestamp_ntz")
    points = points.withColumn("kmp", F.col("kmp").cast("decimal(10,4)")).withColumn("meting_serie_naam", F.col("ident8"))
    parts = [(road, float(a), float(a + 5), "1", "Antwerpen", "H1") for road, _ in roads for a in (0, 5)]
    segments = spark.createDataFrame(parts, "ident8 string, beginpositie double, eindpositie double, district string, provincie string, wegcategorie string")
    segments = segments.withColumns({c: F.col(c).cast("decimal(38,8)") for c in ("beginpositie", "eindpositie")})
    store = Store(spark, str(tmp_path))
    seen = []

    def watched(p, *args, **options):
        seen.append(sorted(r[0] for r in p.select("bestands_url").distinct().collect()))
        return on_segments(p, *args, **options)

    on_segments = located.on_segments
    monkeypatch.setattr(located, "on_segments", watched)

    def run(files, s=segments):
        given_points = points.where(F.col("bestands_url").isin(files))
        got, counts = located.update_located(store, given_points, s, 2024)
        want = on_segments(given_points, s)
        assert rows(got.select("oid", "kmp", "district")) == rows(want.select("oid", "kmp", "district"))
        assert rows(counts) == rows(located.reading_counts(want).select(*counts.columns))

    run(["f0", "f1"])
    run(["f0", "f1"])
    run(["f0", "f1", "f2"])
    run(["f1", "f2", "f3"])
    run(["f0", "f1"])
    assert seen == [["f0", "f1"], ["f2"], ["f3"], ["f0"]]
    with monkeypatch.context() as m:  # broken off between the located rows and their counts
        append = Store.append
        m.setattr(Store, "append", lambda self, table, *a: append(self, table, *a) if table != located.COUNTS else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(["f0", "f1", "f3"])
    run(["f0", "f1", "f3"])
    assert seen[-1] == ["f0", "f1", "f3"]
    run(["f0", "f1", "f3"], segments.where("beginpositie = 0"))
    assert seen[-1] == ["f0", "f1", "f3"]
    run([])
    run(["f2"])
    assert seen[-1] == ["f2"]


def test_queue_parsed_in_parts(spark, tmp_path, rows, monkeypatch):
    """Files parsed one at a time give the log that they give together, also if their outcomes were stored before."""
    from lanelux.plans import pipeline
    from lanelux.schemas import FILE_LOG
    from tests.test_survey import HEAD, body, keyed, write

    for road, folder in (("N0010001", "N0010001"), ("N0010002", "elders"), ("N0010003", "N0010003")):
        write(tmp_path / "in" / folder / f"{road} M1.xls", keyed(body(), head={**HEAD, "Measure Series Name:": f"{road} M1"}))
    write(tmp_path / "in" / "N0010004" / "N0010004 M1.xls", ["Info:\tx", body()])
    read_at = datetime.datetime(2024, 6, 1)
    found = []
    for way, at_once in (("together", 10_000), ("apart", 1), ("apart", 1)):
        monkeypatch.setattr(pipeline, "FILES_AT_ONCE", at_once)
        store = pipeline.Store(spark, str(tmp_path / way))
        new = pipeline.register_files(store, str(tmp_path / "in"), 2024, read_at, spark.createDataFrame([], FILE_LOG))
        new = new.withColumns({"oid": F.xxhash64("drive_file_id"), "measure_series_name": F.lit(None).cast("string"), "name_conform": F.lit(None).cast("boolean")})
        found.append(rows(pipeline.load_queue(store, new.select(*FILE_LOG.names), 2024, read_at)))
        assert store.read("measurement_import", 2024).count() == 2
        assert store.read("file_outcome", 2024).count() == 4
    assert found[0] == found[1] == found[2] and len(found[0]) == 4
    assert all(r[FILE_LOG.names.index("completed_step")] == 4 for r in found[0])
