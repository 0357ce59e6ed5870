"""Segment exports whose quoted texts hold line breaks, read by many tasks."""

import random

import pytest
from pyspark.sql import functions as F

from lanelux.sources import segment_files
from lanelux.sources.segment_files import _CSV, quoted_records, read_segments

COLUMNS = "a string, b string, c string"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    spark.conf.set("spark.sql.files.openCostInBytes", "8")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _ours(spark, path):
    rows = quoted_records(spark, path).select(F.from_csv("value", COLUMNS, _CSV).alias("r")).select("r.*")
    return sorted(map(tuple, rows.collect()), key=str)


def _whole(spark, path):
    reader = spark.read.options(**_CSV).option("header", True).option("enforceSchema", True).option("multiLine", True)
    return sorted(map(tuple, reader.schema(COLUMNS).csv(path).collect()), key=str)


def _field(rng):
    text = "".join(rng.choices(['"', "\t", "\n", "a", "bc", "\\", " "], k=rng.randrange(9)))
    if rng.random() < 0.5:
        return "".join(c for c in text if c not in '"\t\n\\')
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'


@pytest.mark.parametrize("seed", range(4))
def test_random_files_as_with_multi_line(spark, tmp_path, small_splits, seed):
    """Quoted fields of any signs; and, without backslashes, quotes, tabs and breaks in any order. Splits of 40 bytes."""
    rng = random.Random(seed)
    for n in range(12):
        if n % 2:
            text = "\n".join("\t".join(_field(rng) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(30)))
        else:
            text = "".join(rng.choices(['"', "\t", "\n", "a", "bc", '""', '"\t"', '\t"', '"\n', " "], k=rng.randrange(1, 160)))
        (tmp_path / f"{n:02d}.tsv").write_text(f"h\th\th\n{text}\nz", newline="")
    assert _ours(spark, str(tmp_path)) == _whole(spark, str(tmp_path))


@pytest.mark.parametrize(
    "text",
    [
        "",
        "h",
        "h\n",
        '"h\nh"\tx\n1\t2\t3\n',
        "\n\nh\tx\n\n1\n\n",
        'h\r\n"a\r\nb"\tx\r\n1\t"2\r\n"\r\n',
        'h\n"open and never closed\n1\t2\t3\n4',
        'h\n"\\"x\\"\n"\tb\n',
        'h\n"' + "long text\n" * 60 + '"\t2\n"' + "\n" * 99 + '"\n7\n',
        "h\n" + '"x\ny"\t' * 2 + "z\n" + "1\t2\t3\n" * 50,
    ],
)
def test_odd_files_as_with_multi_line(spark, tmp_path, small_splits, text):
    (tmp_path / "one.tsv").write_text(text, newline="")
    if text:
        assert _ours(spark, str(tmp_path)) == _whole(spark, str(tmp_path))
    else:
        assert quoted_records(spark, str(tmp_path)).count() == 0


def test_one_file_in_many_tasks(spark, tmp_path, small_splits, monkeypatch):
    """One file is read by many tasks, also where a record goes over several splits."""
    stored = {}
    settle = segment_files.settle
    monkeypatch.setattr(segment_files, "settle", lambda df, name: stored.setdefault(name, settle(df, name)))
    rows = "".join(f'{n}\t{n}\tN{n:07d}' + "\t" * 9 + f'"a\n\\"b\\" {n}"' + "\t" * 12 + "\n" for n in range(100))
    long = "7\t100\tN" + "\t" * 9 + '"' + "x\n" * 200 + '"' + "\t" * 12 + "\n"
    (tmp_path / "s.tsv").write_text("\t".join(f"c{i}" for i in range(24)) + "\n" + rows + long)
    got = {r["id"]: r["opmerking"] for r in read_segments(spark, str(tmp_path / "s.tsv")).collect()}
    assert got == {**{n: f'a\n"b" {n}' for n in range(100)}, 100: "x\n" * 200}
    splits = stored["segment-splits"].collect()
    assert len(splits) >= 8 and len({r["block"] for r in splits}) == len(splits)
    assert 0 < sum(r["_open"] for r in splits) < len(splits)


def test_both_ways_agree_without_breaks(spark, tmp_path):
    row = '1\t{n}\tN0010001\t0,0\t\t{n}.5\t1.0\t\t2.5\tRegio\ttrue\t"a ""b"" c"\t\t\tx\t2024-01-02\t\t\t\t\t3\tH\t-1\t\n'
    (tmp_path / "s.tsv").write_text("\t".join("abcdefghijklmnopqrstuvwx") + "\n" + "".join(row.format(n=n) for n in range(50)))
    ways = [sorted(map(str, read_segments(spark, str(tmp_path), quoted_breaks=q).collect())) for q in (False, True)]
    assert ways[0] == ways[1] and len(ways[0]) == 50
