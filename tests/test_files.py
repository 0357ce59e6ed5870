"""No file and no line is lost, whichever way a file is read."""

import os
import pathlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lanelux.operators import sinks, survey
from lanelux.sources import catalog
from lanelux.sources.survey_files import file_lines, normalized_lines, scan_survey
from lanelux.streaming.ingest import NAME_TAKEN, start_ingest

from .test_survey import HEAD, READ_AT, body, keyed, write

SOUND = keyed(body(), body(f0="2,5"))
FILES = {
    "sound": (SOUND, survey.FILE_OK, 2),
    "no blank row": ([line for line in SOUND if line != " \t"], survey.NO_HEADER_END, 0),
    "header alone": (SOUND[:8], survey.NO_COLUMN_ROW, 0),
    "columns alone": (SOUND[:9], survey.FILE_OK, 0),
    "no series": ([line for line in SOUND if not line.startswith("Measure Series")], survey.NO_SERIES_NAME, 2),
    "empty series": (keyed(body(), head={**HEAD, "Measure Series Name:": " "}), survey.NO_SERIES_NAME, 1),
    "byte-order mark": (["\xef\xbb\xbf" + SOUND[0], *SOUND[1:]], survey.FILE_OK, 2),
    "empty last line": ([*SOUND, ""], survey.FILE_OK, 3),
}


@pytest.fixture
def folder(tmp_path):
    for name, (lines, _, _) in FILES.items():
        write(tmp_path / "in" / name / f"{name}.xls", lines, "\n")
    (tmp_path / "in" / "sound" / "nothing.xls").write_bytes(b"")
    (tmp_path / "in" / "sound" / "open end.xls").write_bytes("\r\n".join(SOUND).encode("latin-1"))
    return tmp_path / "in"


def _name(url):
    return url.rsplit("/", 1)[-1].removesuffix(".xls")


def test_both_ways_give_the_same_headers_outcomes_and_rows(spark, folder, rows):
    found = [scan_survey(spark, str(folder), whole_file_bytes=size) for size in (1 << 24, 0)]
    heads = [sorted((_name(r["bestands_url"]), *r[1:]) for r in headers.collect()) for headers, _ in found]
    assert heads[0] == heads[1] and len(heads[0]) == len(FILES) + 2
    assert rows(found[0][1]) == rows(found[1][1])
    outcome = {_name(r["bestands_url"]): r["outcome"] for r in found[0][0].collect()}
    counts = {_name(r["bestands_url"]): r["count"] for r in found[0][1].groupBy("bestands_url").count().collect()}
    assert outcome.pop("nothing") == survey.NO_HEADER_END and outcome.pop("open end") == survey.FILE_OK
    assert counts.pop("open end") == 2
    assert outcome == {name: kind for name, (_, kind, _) in FILES.items()}
    assert counts == {name: n for name, (_, _, n) in FILES.items() if n}
    assert {r["toestel"] for r in found[0][0].where("bestands_url like '%mark.xls'").collect()} == {"ZRM"}


@pytest.mark.parametrize("size", [1 << 24, 0])
@pytest.mark.parametrize("conform_only", [False, True])
def test_stream_keeps_rejected_lines_and_files(spark, folder, tmp_path, size, conform_only):
    write(folder / "N0010001" / "N0010001 M1.xls", keyed(body(), body(f2="veel")), "\n")
    table, state = str(tmp_path / "t"), str(tmp_path / "s")
    start_ingest(
        spark, str(folder), table, state, READ_AT, files_per_batch=3, whole_file_bytes=size, conform_only=conform_only
    ).awaitTermination()
    files = {_name(r["bestands_url"]): r for r in spark.read.parquet(f"{table}_files").collect()}
    assert len(files) == len(FILES) + 3
    assert files["nothing"]["outcome"] == survey.NO_HEADER_END
    assert [n for n, r in files.items() if r["name_conform"]] == ["N0010001 M1"]
    good, bad = spark.read.parquet(table), spark.read.parquet(f"{table}_rejected")
    if conform_only:
        assert (good.count(), bad.count()) == (1, 1)
    else:
        _, rows = scan_survey(spark, str(folder))
        assert good.count() + bad.count() == rows.count()


def test_normalized_copies_read_as_one_file_each(spark, tmp_path, rows):
    head = {**HEAD, "Remarks:": "café ÿ", "Measure Series Name:": "N1 M1"}
    many = keyed(*[body(f0=f"{n},5", f7=f"a\\\tb\\\\{n}") for n in range(120)], head=head)
    write(tmp_path / "in" / "N1+" / "N1 M1%.xls", many, "\n")
    write(tmp_path / "in" / "N2" / "N2 M1.xls", keyed(body()), "\n")
    lines = file_lines(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    sinks.write_normalized(lines, out, repair=True, parts=5)
    parts = [p for p in pathlib.Path(out).glob("*/part-*") if p.suffix != ".crc"]
    assert len(parts) > 4 and any("caf\xe9".encode("latin-1") in p.read_bytes() for p in parts)
    again = survey.parse_lines(normalized_lines(spark, out), delimiter=";")
    named = survey.parse_lines(lines)
    repaired = F.transform("columns", lambda f, i: F.when(i == 10, survey.SPEED_COLUMN).otherwise(f))
    assert rows(again) == rows(named.withColumn("columns", repaired))
    assert again.count() == 121


def test_relative_root(spark, folder, monkeypatch):
    monkeypatch.chdir(folder.parent)
    want = sorted((r["path"], r["level"]) for r in catalog.list_files(spark, str(folder), ["xls"], depth=1).collect())
    assert len(want) == len(FILES) + 1 and {level for _, level in want} == {1}
    # Spark resolves a relative path by its own working folder.
    near = os.path.relpath(folder, spark._jvm.java.lang.System.getProperty("user.dir"))
    for root in (near, near + "/", f"file:{folder}", f"file://{folder}/"):
        got = catalog.list_files(spark, root, ["xls"], depth=1)
        assert sorted((r["path"], r["level"]) for r in got.collect()) == want


def test_repeated_and_too_many_column_names(spark):
    tagged = spark.createDataFrame(
        [("f", 1, ["a", "b", "a"], ["1", "2", "3"])], "bestands_url string, line_no long, names array<string>, texts array<string>"
    )
    apart = tagged.withColumn("names", survey._told_apart(F.col("names")))
    row = survey.widen(apart, apart).first()
    assert (row["a"], row["b"], row["a (2)"]) == ("1", "2", "3")
    with pytest.raises(ValueError, match="column names"):
        survey.widen(apart, apart, most_columns=2)


def test_file_without_series_name_is_not_taken(spark):
    row = spark.createDataFrame([("x/N1/N1 M1.xls", None), ("x/N1/N1 M1.xls", "N1 M1")], "bestands_url string, meting_serie_naam string")
    assert [r["meting_serie_naam"] for r in survey.taken_2024(row).collect()] == ["N1 M1"]


def _outcomes(spark, table):
    return {r["bestands_url"].split("/in/")[1]: r["outcome"] for r in spark.read.parquet(f"{table}_files").collect()}


def test_first_name_wins_in_every_later_run(spark, tmp_path):
    """A name belongs to the first file that had it, also one without a byte; a restart keeps that."""
    source, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")

    def run(year):
        start_ingest(spark, str(source), table, state, READ_AT, files_per_batch=2, report_year=year).awaitTermination()
        return _outcomes(spark, table)

    write(source / "B" / "N1 M1.xls", keyed(body()))
    write(source / "C" / "N1 M1.xls", keyed(body(), body()))
    (source / "C" / "N2 M1.xls").write_bytes(b"")
    first = run(2024)
    assert first == {"B/N1 M1.xls": "ok", "C/N1 M1.xls": NAME_TAKEN, "C/N2 M1.xls": survey.NO_HEADER_END}
    write(source / "A" / "N1 M1.xls", keyed(body()))
    write(source / "A" / "N2 M1.xls", keyed(body()))
    write(source / "A" / "N3 M1.xls", keyed(body()))
    assert run(2024) == {**first, "A/N1 M1.xls": NAME_TAKEN, "A/N2 M1.xls": NAME_TAKEN, "A/N3 M1.xls": "ok"}
    write(source / "D" / "N1 M1.xls", keyed(body()))
    assert run(2025)["D/N1 M1.xls"] == "ok"  # a year of its own
    assert spark.read.parquet(table).count() == 3
    assert spark.read.parquet(f"{table}_files").count() == 7


def test_failed_batch_is_repeated_with_the_same_names(spark, tmp_path, monkeypatch):
    from lanelux.streaming import ingest

    source, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    write(source / "B" / "N1 M1.xls", keyed(body()))
    write(source / "C" / "N1 M1.xls", keyed(body()))

    def lost(*args, **options):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest, "import_rows", lost)
        with pytest.raises(Exception, match="lost"):
            start_ingest(spark, str(source), table, state, READ_AT).awaitTermination()
    write(source / "A" / "N1 M1.xls", keyed(body()))
    start_ingest(spark, str(source), table, state, READ_AT).awaitTermination()
    assert _outcomes(spark, table) == {"B/N1 M1.xls": "ok", "C/N1 M1.xls": NAME_TAKEN, "A/N1 M1.xls": NAME_TAKEN}
    assert spark.read.parquet(table).count() == 1


def test_tree_has_empty_and_intermediate_folders(spark, tmp_path):
    write(tmp_path / "r" / "2024" / "a b+%é" / "x.xls", ["x"])
    (tmp_path / "r" / "2023" / "leeg" / "dieper").mkdir(parents=True)
    (tmp_path / "r" / "top.xls").write_bytes(b"")
    (tmp_path / "r" / "_hidden").mkdir()
    root = str(tmp_path / "r")
    tree = catalog.list_tree(spark, root)
    names = {(r["folder_name"], r["folder_id"].split("/r/")[1]) for r in catalog.tree_folders(tree).collect()}
    assert names == {("2024", "2024"), ("2023", "2023"), ("leeg", "2023/leeg"), ("dieper", "2023/leeg/dieper"), ("a b+%é", "2024/a b+%é")}
    files = {r["name"]: (r["level"], r["length"], r["parent_name"]) for r in catalog.tree_files(tree, ["xls"]).collect()}
    assert files == {"x.xls": (2, 3, "a b+%é"), "top.xls": (0, 0, "r")}
    assert {r["level"] for r in catalog.list_tree(spark, root, depth=1).collect()} == {0, 1}
    found = catalog.find_folders(catalog.tree_folders(tree), "2023").first()[0]
    assert catalog.find_folders(catalog.tree_folders(tree), "leeg", parent_id=found).count() == 1
    assert catalog.list_tree(spark, str(tmp_path / "none")).count() == 0
    # The closure of the files' folders, in the same form.
    held = {r["folder_id"] for r in catalog.list_folders(catalog.list_files(spark, root)).collect()}
    tree_ids = {r["folder_id"] for r in catalog.tree_folders(tree).collect()}
    assert {i for i in held if not i.endswith("/r")} == {i for i in tree_ids if "2024" in i}


def test_tree_lists_by_many_tasks(spark, tmp_path, monkeypatch):
    for n in range(40):
        (tmp_path / f"{n}" / "x").mkdir(parents=True)
    monkeypatch.setattr(catalog, "FOLDERS_PER_TASK", 4)
    assert catalog.list_tree(spark, str(tmp_path)).count() == 80


@pytest.mark.parametrize(
    ("folder", "path"),
    [("file:/a/b c", "/a/b c"), ("/a/b", "/a/b"), ("file:///a/%41", "/a/%41"), ("file:/", "/")],
)
def test_system_of_a_folder(folder, path):
    assert catalog._system(folder)[1] == path


def test_many_batches_are_read_by_one_load(spark, tmp_path, monkeypatch):
    """Batches are full and few, their files are read together, and each keeps its own partition."""
    from lanelux.streaming import ingest

    source, table, state, loads = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s"), []
    for n in range(7):
        write(source / f"N{n}" / f"N{n} M1.xls", keyed(body(), body()))

    def scan(session, paths, *args, **options):
        loads.append(len(paths))
        return scan_files(session, paths, *args, **options)

    scan_files = ingest.scan_files
    monkeypatch.setattr(ingest, "scan_files", scan)
    for _ in range(2):
        start_ingest(spark, str(source), table, state, READ_AT, files_per_batch=2).awaitTermination()
        assert loads == [7]
    for path, n in ((table, 2), (f"{table}_files", 1)):
        counts = {r["batch"]: r["count"] // n for r in spark.read.parquet(path).groupBy("batch").count().collect()}
        assert sorted(counts) == [0, 1, 2, 3] and sorted(counts.values()) == [1, 2, 2, 2]
    monkeypatch.setattr(ingest, "FILES_PER_LOAD", 4)
    for n in range(7, 12):
        write(source / f"N{n}" / f"N{n} M1.xls", keyed(body()))
    start_ingest(spark, str(source), table, state, READ_AT, files_per_batch=2).awaitTermination()
    assert sorted(loads[1:]) in ([1, 4], [2, 3])
    assert spark.read.parquet(table).count() == 19


def test_copies_are_replaced_as_a_whole(spark, tmp_path, rows):
    """Names are those that Spark's writer gives; a run that fails leaves the copies before it."""
    schema, out = "bestands_url string, line_no long, value string", str(tmp_path / "out")
    urls = ["a/b c+%é=1.xls", "q'\"#*?:\\{x}[y]^~", "", None, "z|<>&;$\x7f"]
    lines = spark.createDataFrame([(u, n, f"{n}\té€") for u in urls for n in range(3)], schema)
    sinks.write_normalized(lines, out, parts=2)
    spark.createDataFrame([(u, "x") for u in urls], "bestands_url string, value string").write.partitionBy("bestands_url").text(f"{out}-spark")
    folders = lambda path: {p.name for p in pathlib.Path(path).glob("bestands_url=*")}
    assert folders(out) == folders(f"{out}-spark") and len(folders(out)) == 4
    copy = sorted(pathlib.Path(out).glob("bestands_url=a*/part-*"))
    assert b"".join(p.read_bytes() for p in copy) == b"0;\xe9?\n1;\xe9?\n2;\xe9?\n"
    assert not list(pathlib.Path(out).glob("bestands_url=*/*.crc"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_normalized(lines.withColumn("value", F.raise_error(F.lit("lost")).cast("string")), out)
    read = spark.read.option("basePath", out).text(out)
    assert read.count() == 15 and len(list(tmp_path.iterdir())) == 2
    sinks.write_normalized(lines.limit(1), out)
    assert spark.read.option("basePath", out).text(out).count() == 1


def test_batches_of_the_stream_share_few_state_tasks(spark, tmp_path):
    """However finely tables are shuffled; a run with another setting goes on with the same names."""
    source, table, state = tmp_path / "in", str(tmp_path / "t"), tmp_path / "s"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for tasks, folder in ((23, "B"), (2, "A")):
            spark.conf.set("spark.sql.shuffle.partitions", tasks)
            write(source / folder / "N1 M1.xls", keyed(body()))
            start_ingest(spark, str(source), table, str(state), READ_AT).awaitTermination()
            assert spark.conf.get("spark.sql.shuffle.partitions") == str(tasks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len([p for p in (state / "state" / "0").iterdir() if p.name.isdigit()]) == 4
    assert _outcomes(spark, table) == {"B/N1 M1.xls": "ok", "A/N1 M1.xls": NAME_TAKEN}


def test_stream_decides_on_many_batches_at_a_time(spark, tmp_path, monkeypatch):
    """Batches stay as small as asked for, the stream takes several of them in one step; names hold over steps."""
    from lanelux.streaming import ingest

    source, table, state = tmp_path / "in", str(tmp_path / "t"), tmp_path / "s"

    def run(*folders):
        for folder in folders:
            write(source / folder / f"{folder[1:]} M1.xls", keyed(body()))
        start_ingest(spark, str(source), table, str(state), READ_AT, files_per_batch=2).awaitTermination()
        counts = spark.read.parquet(f"{table}_files").groupBy("batch").count()
        steps = [p for p in (state / "commits").iterdir() if p.name.isdigit()]
        return len(steps), sorted(r["count"] for r in counts.collect())

    assert run(*[f"BN{n}" for n in range(7)]) == (1, [1, 2, 2, 2])
    monkeypatch.setattr(ingest, "FILES_PER_STEP", 5)  # two whole batches
    assert run("AN3", "AN8", "BN9", "CN9", "CN10") == (3, [1, 1, 2, 2, 2, 2, 2])
    taken = {name for name, outcome in _outcomes(spark, table).items() if outcome == "ok"}
    assert {n.split("/")[0] for n in taken} == {*[f"BN{n}" for n in range(7)], "AN8", "BN9", "CN10"}
    assert spark.read.parquet(table).count() == 10


def test_listing_of_an_earlier_version_is_one_batch_a_step(spark, tmp_path):
    """Listed and decided files without a part keep their batch, whose number is the step's."""
    source, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")
    for n in range(3):
        write(source / "B" / f"N{n} M1.xls", keyed(body()))
        listed = [(f"file:{source}/B/N{n} M1.xls", f"N{n} M1.xls", READ_AT.year, True)]
        one = spark.createDataFrame(listed, "path string, name string, report_year int, candidate boolean")
        one.coalesce(1).write.mode("append").parquet(f"{table}_listing")
    write(source / "A" / "N0 M1.xls", keyed(body()))
    for _ in range(2):
        start_ingest(spark, str(source), table, state, READ_AT, files_per_batch=2).awaitTermination()
    files = spark.read.parquet(f"{table}_files").select("batch", "outcome").collect()
    assert len(files) == 4 and {r["outcome"] for r in files if r["batch"] < 3} == {"ok"}
    assert [r["outcome"] for r in files if r["batch"] > 2] == [NAME_TAKEN]
    assert spark.read.parquet(table).count() == 3


def test_copies_are_read_as_spark_reads_them(spark, tmp_path, monkeypatch):
    """Line breaks inside values, byte-order marks, bytes that are no UTF-8, rows without a file, and large parts."""
    schema, out = "bestands_url string, line_no long, value string", str(tmp_path / "out")
    texts = ["ï»¿a\té", "ï»¿b\r", "c\r\nd\r\r\ne", "", "\r", None, "x" * 40, "ü\n\n"]
    urls = ["a/b c+%é=1.xls", "q'\"#*?:\\{x}[y]^~", "", None]
    rows = [(u, n, texts[(n + i) % len(texts)]) for i, u in enumerate(urls) for n in range(len(texts))]
    lines = spark.createDataFrame(rows, schema)
    for encoding in ("ISO-8859-1", "UTF-8"):
        sinks.write_normalized(lines, out, parts=3, encoding=encoding)
        of = [F.col("bestands_url"), F.hex(F.col("value").cast("binary")).alias("value")]
        want = spark.read.option("basePath", out).text(out).select(*of).collect()
        for chunk in (1 << 20, 1):
            monkeypatch.setattr(sinks, "_CHUNK", chunk)
            lines_of = sinks._lines_of
            for part in pathlib.Path(out).glob("bestands_url=*/part-*"):
                with pa.OSFile(str(part)) as stream:
                    assert [line for some in lines_of(stream) for line in some] == part.read_bytes().removeprefix(b"\xef\xbb\xbf").splitlines()
        got = sinks.read_normalized(spark, out)
        assert dict(got.dtypes) == {"bestands_url": "string", "value": "string"}
        assert sorted(got.select(*of).collect(), key=str) == sorted(want, key=str) and len(want) > 40
    sinks.write_normalized(lines.limit(0), out)
    assert sinks.read_normalized(spark, out).count() == 0


def test_copies_are_not_listed_on_the_driver(spark, tmp_path):
    """Nor named there to the tasks: the plan has the table of the parts alone, whatever their number."""
    from checks.queries import QUERIES

    events = [(i, f"2024-01-{1 + i % 28:02d} 10:00:00", i % 23, ("view", "click")[i % 2], i / 7, "{}") for i in range(60)]
    schema = "event_id long, ts string, user_id long, event_type string, value double, props string"
    rows = spark.createDataFrame(events, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    rows.write.parquet(str(tmp_path / "events.parquet"))
    copies = QUERIES["survey_normalized_lines"](spark, str(tmp_path))
    assert not [f for f in copies.inputFiles() if "bestands_url=" in f]
    named = copies.groupBy("bestands_url").count().collect()
    assert len(named) == 46 and sum(r["count"] for r in named) > 60
