import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lanelux.operators import sinks, survey
from lanelux.schemas import HEADER_KEYS
from lanelux.sources import catalog
from lanelux.sources.segment_files import read_segments
from lanelux.sources.survey_files import file_lines, read_survey, scan_survey
from lanelux.streaming.ingest import start_ingest

READ_AT = datetime.datetime(2024, 1, 1)
COLUMNS = ["Position km", "Date", "RL", *[f"c{i}" for i in range(3, 22)]]
HEAD = {
    "Info:": "ZRM", "Measure Series Name:": "N0010001 M1", "Lane:": "R1", "Side:": "L", "Marking Name:": "M1",
    "Remarks:": "café", "Driver Name:": "jan",
}


def body(**changes):
    fields = ["1,2345", "03/04/2024 05:06:07", "120", "100", "140", "9", "95", "-", "12", "80", "55,5", "ref"]
    fields += ["4,123456789", "50,5", "4,2", "50,6", "-", "a.jpgb.jpg", "-", "c.jpgd.jpg", "e.jpgf.jpg", "-"]
    for at, value in changes.items():
        fields[int(at[1:])] = value
    return "\t".join(fields)


def keyed(*lines, head=HEAD):
    return [*[f"{k}\t{v}" for k, v in head.items()], " \t", "\t".join(COLUMNS), *lines]


def write(path, lines, end="\r\n", encoding="latin-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((end.join(lines) + end).encode(encoding))


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "N0010001" / "N0010001 M1.xls", keyed(body(), body(f0="2,5", f1="2024-04-03 05:06:08", f7='Ob"st;akel')))
    write(tmp_path / "N0010002" / "N0010002 M2.xls", keyed(body(f2="0"), head={**HEAD, "Measure Series Name:": "N0010002 M2"}), "\n")
    (tmp_path / "N0010001" / "nota.txt").write_text("geen meting")
    write(tmp_path / "N0010002" / "BOVEN.XLS", ["x"])
    return tmp_path


def names_of(df):
    return sorted(r["bestands_url"].rsplit("/", 1)[-1] for r in df.select("bestands_url").distinct().collect())


def test_keyed_file(spark, folder):
    rows = read_survey(spark, str(folder))
    assert names_of(rows) == ["N0010001 M1.xls", "N0010002 M2.xls"]
    got = survey.import_rows(rows, READ_AT).orderBy("meting_serie_naam", "line_no").collect()
    first = got[0]
    assert len(got) == 3 and all(r["errors"] == [] for r in got)
    assert first["kmp"] == Decimal("1.2345") and first["rl"] == 120 and first["snelheid"] == Decimal("55.50")
    assert first["tijdstip_meting"] == datetime.datetime(2024, 4, 3, 5, 6, 7)
    assert first["tijdstip_meting_tekst"] == "2024-04-03 05:06:07"
    assert first["locatieomschrijving"] == "café"
    assert first["longitude_start"] == Decimal("4.123456789")
    assert (first["naam_foto1"], first["naam_foto2"]) == ("b.jpg", "d.jpg")
    assert got[1]["marker"] == "Obstakel"
    assert got[1]["tijdstip_meting"] == datetime.datetime(2024, 4, 3, 5, 6, 8)
    assert len({r["oid"] for r in got}) == 3


@pytest.mark.parametrize("split_bytes", ["134217728", "700"])
def test_line_path_equals_whole_file_path(spark, folder, rows, split_bytes):
    many = [body(f0=f"{i},5", f7="x" * (i % 30)) for i in range(300)]
    write(folder / "N0010003" / "N0010003+ M1%é.xls", keyed(*many, head={**HEAD, "Lane:": "R9"}), "\n")
    whole = read_survey(spark, str(folder)).cache()
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        lines = file_lines(spark, str(folder))
        by_line = survey.parse_lines(lines)
        assert rows(by_line) == rows(whole)
        mixed = read_survey(spark, str(folder), whole_file_bytes=2000)
        assert rows(mixed) == rows(whole)
        assert whole.count() == 303
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
        whole.unpersist()


def test_line_path_with_many_files_and_hot_file(spark, rows):
    lines = [("big", i, v) for i, v in enumerate(keyed(*[body(f0=f"{n},0") for n in range(50)]))]
    for f in range(6):
        lines += [(f"f{f}", i, v) for i, v in enumerate(keyed(body()))]
    df = spark.createDataFrame(lines, "bestands_url string, line_no long, value string")
    plain = survey.parse_lines(df)
    spread = survey.parse_lines(df, broadcast_rows=3, rows_per_task=20)
    assert rows(plain) == rows(spread) and plain.count() == 56


def test_header_lines_are_sorted_in_bounded_tasks(spark, rows, monkeypatch):
    files = {f"f{k}": keyed(body(), head=HEAD | {"Lane:": f"R{k}"}) for k in range(40)} | {"none": ["a\tb"] * 30}
    files |= {f"p{k}": [f"k\tv{i} {k}" for i in range(18)] + ["\t".join(COLUMNS), body()] for k in range(40)}
    lines = spark.createDataFrame(
        [(f, i, v) for f, own in files.items() for i, v in enumerate(own)], "bestands_url string, line_no long, value string"
    ).coalesce(1)
    ways = [*[lambda w=w: survey.line_headers(lines, w) for w in ("keyed", "positional", "mixed")], lambda: survey.header_entries(lines)]
    wanted, plans, inner = [rows(way()) for way in ways], [], survey.settle

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return inner(df, name)

    monkeypatch.setattr(survey, "settle", seen)
    monkeypatch.setattr(survey, "SORT_ROWS", 50)
    assert [rows(way()) for way in ways] == wanted
    assert sum(name == "headers" and "REPARTITION_BY_NUM" in plan for name, plan in plans) == 4


def test_repeated_header_key_and_blank_variants(spark):
    lines = ["Remarks:\teerst", *[f"{k}\t{v}" for k, v in HEAD.items() if k != "Remarks:"], "Remarks:\tlaatst", '";\tx', "\t".join(COLUMNS), body()]
    df = spark.createDataFrame([("f", "\n".join(lines))], "bestands_url string, content string")
    row = survey.parse_files(df).first()
    assert row["locatieomschrijving"] == "laatst" and row["columns"][0] == "Position km" and row["line_no"] == 10
    numbered = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "bestands_url string, line_no long, value string")
    assert survey.parse_lines(numbered).collect() == [row]
    entries = {r["key"]: r["value"] for r in survey.header_entries(numbered).collect()}
    assert entries == {**HEAD, "Remarks:": "laatst"}


def test_header_longer_than_the_first_look(spark):
    lines = [f"k{i}\tv" for i in range(500)] + keyed(body())
    df = spark.createDataFrame([("f", "\n".join(lines))], "bestands_url string, content string")
    assert survey.parse_files(df).count() == 1


def test_header_end_is_looked_for_without_splitting_all_lines(spark):
    ends = ["", " \t", '";\\ \tx', "\\\t\tx", "\x85\xa0\tx"]
    for end in [*ends, "\\\\\tx", "-\t"]:
        lines = [*keyed()[:7], end, "\t".join(COLUMNS), body()]
        whole = spark.createDataFrame([("f", "\n".join(lines))], "bestands_url string, content string")
        heads = survey.file_headers(whole)
        assert heads.first()["outcome"] == (survey.FILE_OK if end in ends else survey.NO_HEADER_END), end
    plan = heads._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"transform\(slice\(_lines#\d+, 1, 200\), lambdafunction\(CASE WHEN RLIKE\(lambda", plan)


def test_file_without_blank_row_has_no_body(spark):
    df = spark.createDataFrame([("f", "Info:\tx\nLane:\ty\n")], "bestands_url string, content string")
    assert survey.parse_files(df).count() == 0
    numbered = spark.createDataFrame([("f", 0, "Info:\tx")], "bestands_url string, line_no long, value string")
    assert survey.parse_lines(numbered).count() == 0


@pytest.mark.parametrize(
    "line, delimiter, fields",
    [
        ("a\tb", "\t", ["a", "b"]),
        ("a\\\tb\tc", "\t", ["a\tb", "c"]),
        ("a\\\\\tb", "\t", ["a\\", "b"]),
        ("a\\\\\\\tb", "\t", ["a\\\tb"]),
        ("a\\bc\t", "\t", ["abc", ""]),
        ('"a;b"\t;', "\t", ["ab", ""]),
        ("a\\;b;c", ";", ["ab", "c"]),
        ('"a;b"', ";", ["a", "b"]),
        ("", "\t", [""]),
    ],
)
def test_split_fields(spark, line, delimiter, fields):
    df = spark.createDataFrame([(line,)], "v string")
    assert df.select(survey.split_fields(F.col("v"), delimiter)).first()[0] == fields


def test_normalized_copy_parses_to_the_same_rows(spark, folder, tmp_path, rows):
    lines = file_lines(spark, str(folder))
    out = str(tmp_path / "uit")
    sinks.write_normalized(lines, out)
    import pathlib

    texts = {}
    for part in sorted(pathlib.Path(out).glob("*/part-*")):
        texts[part.parent.name] = texts.get(part.parent.name, []) + part.read_text("latin-1").splitlines()
    assert any("Position km;Date;RL" in line for t in texts.values() for line in t)
    renumbered = [(k, i, v) for k, t in texts.items() for i, v in enumerate(t)]
    df = spark.createDataFrame(renumbered, "bestands_url string, line_no long, value string")
    again = survey.parse_lines(df, delimiter=";").drop("bestands_url")
    assert rows(again) == rows(survey.parse_lines(lines).drop("bestands_url"))


def test_positional_layout(spark, tmp_path, rows):
    lines = [f"r{i}\tv{i}" for i in range(18)] + ["\t".join(COLUMNS), body(f16="p.jpg", f17="q.jpg"), body(f1="4-3-2024 5:6:7")]
    write(tmp_path / "a" / "a.xls", lines)
    parsed = read_survey(spark, str(tmp_path), layout="positional")
    got = survey.import_rows(parsed, READ_AT, "positional").orderBy("line_no").collect()
    assert (got[0]["toestel"], got[0]["meting_serie_naam"], got[0]["operator_naam"]) == ("v0", "v2", "v12")
    assert (got[0]["naam_foto1"], got[0]["naam_foto2"]) == ("p.jpg", "q.jpg")
    assert got[0]["tijdstip_meting_tekst"] == "03/04/2024 05:06:07"
    assert got[1]["tijdstip_meting"] == datetime.datetime(2024, 3, 4, 5, 6, 7)
    by_line = survey.parse_lines(file_lines(spark, str(tmp_path)), "positional")
    assert rows(by_line) == rows(parsed)


def test_mixed_layouts_in_one_folder(spark, tmp_path, rows):
    """Each file is read by its own rules, whole and line by line, as in a scan of its own."""
    old = [f"r{i}\tv{i}" for i in range(18)]
    old[2] = "reeks\tOUD M1"
    series = {**HEAD, "Measure Series Name:": "NIEUW M1"}
    write(tmp_path / "oud" / "OUD M1.xls", [*old, "\t".join(COLUMNS), body(f16="p.jpg", f17="q.jpg"), body(f1="4-3-2024 5:6:7")])
    # A blank first field, as positional headers may have, does not make a file keyed.
    blank = [*old[:4], "\tleeg", *old[5:]]
    write(tmp_path / "oud" / "OUD M2.xls", [*blank, "\t".join(COLUMNS), body(f7='Ob"st;akel')])
    write(tmp_path / "nieuw" / "NIEUW M1.xls", keyed(body(f7='Ob"st;akel'), head=series))
    # The keyed rules fit, so they count, whatever stands in line 18.
    long = keyed(body(), head=series | {f"k{i}": "v" for i in range(10)})
    assert long[18] == "\t".join(COLUMNS)
    write(tmp_path / "nieuw" / "NIEUW M2.xls", long)
    write(tmp_path / "niets" / "niets.xls", ["Info:\tx", body()])
    write(tmp_path / "niets" / "leeg.xls", [], "")

    def scan(folder, **options):
        headers, parsed = scan_survey(spark, str(tmp_path / folder), **options)
        told = {r["bestands_url"].rsplit("/", 1)[-1]: (r["outcome"], r["layout"]) for r in headers.collect()} if "layout" in headers.columns else None
        return told, survey.import_rows(parsed, READ_AT, options.get("layout", "keyed"))

    told, mixed = scan("", layout="mixed")
    by_line, lines = scan("", layout="mixed", whole_file_bytes=0)
    assert told == by_line == {
        "OUD M1.xls": ("ok", "positional"), "OUD M2.xls": ("ok", "positional"), "NIEUW M1.xls": ("ok", "keyed"),
        "NIEUW M2.xls": ("ok", "keyed"), "niets.xls": ("no header end", "keyed"), "leeg.xls": ("no header end", "keyed"),
    }
    apart = scan("oud", layout="positional")[1].unionByName(scan("nieuw")[1])
    assert rows(mixed) == rows(lines) == rows(apart) and mixed.count() == 5
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
        assert rows(scan("", layout="mixed", whole_file_bytes=0)[1]) == rows(apart)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_bad_rows_are_set_apart(spark):
    lines = keyed(body(), body(f2="veel"), body(f1="31/02/2024 00:00:00"), body(f11="r" * 26), body(f4=""))
    df = spark.createDataFrame([("f", "\n".join(lines))], "bestands_url string, content string")
    imported = survey.import_rows(survey.parse_files(df), READ_AT)
    bad = {r["line_no"]: r["errors"] for r in survey.rejected(imported).collect()}
    assert bad == {10: ["rl"], 11: ["tijdstip_meting"], 12: ["reference"]}
    good = survey.accepted(imported)
    assert good.count() == 2 and good.where("rlmax IS NULL").count() == 1


def test_short_line_is_set_apart(spark):
    df = spark.createDataFrame([("f", "\n".join(keyed(body(), "1,5")))], "bestands_url string, content string")
    assert survey.rejected(survey.import_rows(survey.parse_files(df), READ_AT)).count() == 1


def test_combined_2024(spark, tmp_path, rows):
    def series(n):
        return {**HEAD, "Measure Series Name:": n}

    write(tmp_path / "N0010001" / "N0010001 M1.xls", keyed(body(), body(f2="0"), body(f2="0,0"), head=series("N0010001 M1")))
    write(tmp_path / "elders" / "N0010002 M1.xls", keyed(body(), head=series("N0010002 M1")))
    write(tmp_path / "N0010003" / "N0010003 M2.xls", keyed(body(), head=series("N0010003 M1")))
    other = keyed(body(), head=series("N0010004 M2"))
    other[-2] = other[-2].replace("c5", "anders")
    write(tmp_path / "N0010004" / "N0010004 M2.xls", other)
    def combined(**options):
        headers, parsed = scan_survey(spark, str(tmp_path), **options)
        return survey.combined_2024(parsed, headers)

    got, by_line = combined(), combined(whole_file_bytes=0)
    assert by_line.columns == got.columns and rows(by_line) == rows(got)
    assert got.columns[2:6] == ["meting_serie_naam", "ident8", "markering", "Position km"]
    assert "Speed km/h km/h" in got.columns and "c16" not in got.columns
    found = sorted((r["ident8"], r["markering"], r["RL"], r["c5"], r["anders"]) for r in got.collect() if r["c5"])
    assert found == [("N0010001", "M1", "0,0", "9", None), ("N0010001", "M1", "120", "9", None)]
    assert [r["anders"] for r in got.collect() if r["ident8"] == "N0010004"] == ["9"]


def test_repair_header(spark):
    df = spark.createDataFrame([(COLUMNS,), (["x"] * 12,)], "f array<string>")
    first, second = [r[0] for r in df.select(survey.repair_header(F.col("f"))).collect()]
    assert first[10] == "Speed km/h km/h" and first[9] == "c9" and second == ["x"] * 12


# --- listings ---------------------------------------------------------------


def test_list_files(spark, folder):
    write(folder / "diep" / "dieper" / "x.xls", ["a"])

    def found(**kwargs):
        return sorted(r["name"] for r in catalog.list_files(spark, str(folder), **kwargs).collect())

    assert found(extensions=["xls"], depth=1) == ["N0010001 M1.xls", "N0010002 M2.xls"]
    assert found(extensions=["xls"]) == ["N0010001 M1.xls", "N0010002 M2.xls", "x.xls"]
    assert found(extensions=["xls"], depth=0) == []
    assert len(found()) == 5
    one = catalog.list_files(spark, str(folder), ["XLS"]).first()
    assert (one["parent_name"], one["level"]) == ("N0010002", 1)


def test_folders(spark, folder):
    folders = catalog.list_folders(catalog.list_files(spark, str(folder)))
    assert sorted(r["folder_name"] for r in folders.collect()) == ["N0010001", "N0010002"]
    found = [r["folder_id"] for r in catalog.find_folders(folders, "N0010001").collect()]
    assert len(found) == 1 and found[0].endswith("/N0010001")
    parent = found[0].rsplit("/", 1)[0]
    assert catalog.find_folders(folders, "N0010001", parent).count() == 1
    assert catalog.find_folders(folders, "N0010001", parent + "x").count() == 0


def test_search_files_repeats_a_path_per_match(spark, folder):
    files = catalog.list_files(spark, str(folder))
    hits = catalog.search_files(files, [".xls", "s"], ["", "M2", "geen"])
    names = sorted(r["path"].rsplit("/", 1)[-1] for r in hits.collect())
    assert names == ["N0010001 M1.xls"] * 2 + ["N0010002 M2.xls"] * 4


# --- segments ---------------------------------------------------------------


def test_read_segments(spark, tmp_path):
    head = "\t".join(f"h{i}" for i in range(24))
    row = ["77", "1", "N0010001", "0", "0", "0,5", "10", "0", "10.5", '"Regio ""x"', "true", '"a\tb"', "10", "", "jan"]
    row += ["2024-01-02 03:04:05", "2024-01-02", "", "", "", "x", "H", "-3", "2024-01-02 03:04:05"]
    row[9], row[14] = "Regio D11142", '"jan ""de"" x"'
    (tmp_path / "s.tsv").write_text(head + "\n" + "\t".join(row) + "\n" + "\t".join(row).replace('"a\tb"', '"a\nb"') + "\n")
    first, second = read_segments(spark, str(tmp_path / "s.tsv")).collect()
    assert "objectid" not in first.asDict()
    assert (first["id"], first["eindpositie"], first["offset_"]) == (1, Decimal("10.50000000"), -3)
    assert first["beginpositie"] is None and first["bronid"] is None and first["werkelijkelengte"] is None
    assert first["gebruiker"] == 'jan "de" x' and first["eigenbeheer"] == "true"
    assert first["opmerking"] == "a\tb" and second["opmerking"] == "a\nb"
    assert first["opnamedatum"] == datetime.datetime(2024, 1, 2, 3, 4, 5)


# --- streaming --------------------------------------------------------------


@pytest.mark.parametrize("whole_file_bytes", [16_000_000, 0])
def test_stream_loads_each_file_once(spark, tmp_path, whole_file_bytes):
    source, table, state = tmp_path / "in", str(tmp_path / "tabel"), str(tmp_path / "state")

    def run():
        start_ingest(spark, str(source), table, state, READ_AT, files_per_batch=1, whole_file_bytes=whole_file_bytes).awaitTermination()
        return spark.read.parquet(table).count()

    write(source / "N1" / "N1 M1.xls", keyed(body(), body()))
    write(source / "N1" / "N1 M2.xls", keyed(body()))
    assert run() == 3
    assert run() == 3
    write(source / "N2" / "N2 M1.xls", keyed(body(), body(f2="veel")))
    assert run() == 4


def test_header_keys_fill_all_header_columns():
    assert list(HEADER_KEYS.values()) == survey.HEADER_COLUMNS
