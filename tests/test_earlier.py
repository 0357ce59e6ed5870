import datetime

import pytest

from lanelux.plans import earlier
from lanelux.schemas import CONFORM
from lanelux.sources.survey_files import normalized_lines
from tests.test_survey import COLUMNS, HEAD, body, keyed, write

FIRST, SECOND, THIRD = (datetime.datetime(2024, m, 1) for m in (6, 7, 8))


def series(name):
    return {**HEAD, "Measure Series Name:": name}


def positional(name, *lines):
    head = [f"r{i}\tv{i}" for i in range(18)]
    head[2] = f"reeks\t{name}"
    head[9] = "zijde\tL"
    return [*head, "\t".join(COLUMNS), *lines]


def of(df, *columns):
    return sorted(tuple(r[c].rsplit("/", 1)[-1] if c == "bestands_url" else r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("size", [16 << 20, 0])
def test_run_2024(spark, tmp_path, size):
    source = tmp_path / "in"
    write(source / "N0010001" / "N0010001 M1.xls", keyed(body(), body(f2="0"), body(f2="0,0"), head=series("N0010001 M1")))
    write(source / "elders" / "N0010002 M1.xls", keyed(body(), head=series("N0010002 M1")))
    write(source / "N0010003" / "N0010003 M2.xls", keyed(body(), head=series("N0010003 M1")))
    write(source / "N0010004" / "N0010004 M1.xls", ["Info:\tx", body()])
    write(source / "N0010004" / "N0010004 M2.xls", [], "")
    for _ in range(2):
        got = earlier.run_2024(spark, str(source), str(tmp_path / "uit"), whole_file_bytes=size)
        assert of(got["file_outcome"], "bestands_url", "outcome") == [
            ("N0010001 M1.xls", "ok"), ("N0010002 M1.xls", "map"), ("N0010003 M2.xls", "reeks"),
            ("N0010004 M1.xls", "no header end"), ("N0010004 M2.xls", "no header end"),
        ]
        assert of(got["combined"], "ident8", "markering", "RL") == [("N0010001", "M1", "0,0"), ("N0010001", "M1", "120")]
        assert "Speed km/h km/h" in got["combined"].columns
        copies = normalized_lines(spark, str(tmp_path / "uit" / "normalized"))
        assert {r["bestands_url"].rsplit("/", 1)[-1] for r in copies.collect()} == {"N0010001 M1.xls"}
        assert copies.count() == 12 and copies.where("value like 'Position km;%;Speed km/h km/h;%'").count() == 1


def test_run_2024_without_a_taken_file(spark, tmp_path):
    write(tmp_path / "in" / "elders" / "N0010002 M1.xls", keyed(body(), head=series("N0010002 M1")))
    got = earlier.run_2024(spark, str(tmp_path / "in"), str(tmp_path / "uit"), copies=False)
    assert got["combined"].count() == 0 and of(got["file_outcome"], "outcome") == [("map",)]


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "Meetjaar 2022" / "in"
    write(root / "N0010001" / "N0010001 M1.xls", positional("N0010001 M1", body(), body(f2="veel")))
    write(root / "elders" / "N0010002 M1.xls", positional("N0010002 M1", body(), body()))
    write(root / "N0010003" / "N0010003 M1.xls", positional("", body()))
    return root


def test_run_2022(spark, tmp_path, source, monkeypatch):
    monkeypatch.setattr(earlier.pipeline, "FILES_AT_ONCE", 2)

    def run(at):
        return earlier.run_2022(spark, str(source), str(tmp_path / "uit"), "Meetjaar ", 2022, at)

    got = run(FIRST)
    status = {r["map_bestand"]: r["ctr_header_bestandsnaam"] for r in got["legacy_log"].collect()}
    assert status == {
        "2022/in/N0010001/N0010001 M1.xls": CONFORM,
        "2022/in/elders/N0010002 M1.xls": "bestandsnaam conform header / bestandsmap NIET conform header!",
    }
    assert of(got["file_outcome"], "bestands_url", "outcome") == [
        ("N0010001 M1.xls", "ok"), ("N0010002 M1.xls", "ok"), ("N0010003 M1.xls", "no series name"),
    ]
    assert got["legacy_backlog"].first()["n"] == 3 and got["nonconform"].first()["n"] == 1
    assert of(got["measurement_raw"], "bestands_url") == [("N0010001 M1.xls",), ("N0010002 M1.xls",), ("N0010002 M1.xls",)]
    assert of(got["measurement_conform"], "bestands_url") == [("N0010001 M1.xls",)]
    assert of(got["measurement_rejected"], "bestands_url") == [("N0010001 M1.xls",)]
    # The wrong folder is put right, so the file is read again under its new path, and its old lines are gone.
    write(source / "N0010002" / "N0010002 M1.xls", (source / "elders" / "N0010002 M1.xls").read_text().splitlines())
    (source / "elders" / "N0010002 M1.xls").write_text("leeg")
    got = run(SECOND)
    assert got["legacy_backlog"].first()["n"] == 3 and got["nonconform"].first()["n"] == 0
    assert [r["bestands_url"].rsplit("/", 2)[-2] for r in got["ingested"].collect()] == ["N0010001", "N0010002"]
    assert got["measurement_raw"].count() == got["measurement_conform"].count() == 3
    assert got["measurement_raw"].select("bestands_url", "line_no").distinct().count() == 3
    assert of(got["file_outcome"], "bestands_url", "outcome")[0] == ("N0010002 M1.xls", "no column row")
    # A run without anything new changes nothing.
    third = run(THIRD)
    assert third["legacy_log"].count() == 2 and third["measurement_raw"].count() == 3


def test_run_2022_broken_off_before_the_log(spark, tmp_path, source, monkeypatch):
    """Lines are stored before log rows; a run that ends between does not store them twice."""
    args = (spark, str(source), str(tmp_path / "uit"), "Meetjaar ", 2022)
    append = earlier.Store.append

    def broken(self, table, df, year):
        if table == "legacy_log":
            raise RuntimeError("lost")
        return append(self, table, df, year)

    monkeypatch.setattr(earlier.Store, "append", broken)
    with pytest.raises(RuntimeError):
        earlier.run_2022(*args, FIRST)
    monkeypatch.setattr(earlier.Store, "append", append)
    got = earlier.run_2022(*args, SECOND)
    assert got["legacy_log"].count() == 2 and got["measurement_raw"].count() == 3
    with pytest.raises(ValueError):
        earlier.run_2022(spark, str(source), str(tmp_path / "uit"), "elders", 2022, FIRST)


def test_run_2022_of_mixed_layouts(spark, tmp_path, source):
    write(source / "N0010005" / "N0010005 M1.xls", keyed(body(f17="-", f19="a.jpgb.jpg"), head=series("N0010005 M1")))
    got = earlier.run_2022(spark, str(source), str(tmp_path / "uit"), "Meetjaar ", 2022, FIRST, layout="mixed")
    assert of(got["measurement_conform"], "bestands_url", "naam_foto1") == [("N0010001 M1.xls", "-"), ("N0010005 M1.xls", "b.jpg")]
