"""Parsing of survey files: a key/value header, a column row and body rows.

Two forms feed the same parser rules. :func:`parse_files` takes one row per
file and needs no shuffle. :func:`parse_lines` takes numbered lines, so a file
of any size is parsed by many tasks; only small per-file facts are shuffled.
Both return one row per body line with ``bestands_url``, ``line_no``, the
header columns, the column names and the field texts.

A file's layout is ``keyed`` or ``positional``. With ``mixed`` each file has its own, and headers and body
rows name it in ``layout``: a file is positional if the keyed rules do not fit it and the positional ones do.
"""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanelux.functions import text
from lanelux.functions.times import iso_text, measure_time, measure_time_legacy, stamp
from lanelux.operators.joins import BROADCAST_ROWS, ROWS_PER_TASK, skew_safe_join
from lanelux.schemas import (
    HEADER_KEYS,
    MEASUREMENT_RAW,
    POSITIONAL_COLUMN_LINE,
    POSITIONAL_HEADER,
    TEXT_LIMITS,
)
from lanelux.session import settle

HEADER_COLUMNS = list(HEADER_KEYS.values())
_OUT = ["bestands_url", "line_no", *HEADER_COLUMNS, "columns", "fields"]
#: The column name that marks a column row, and the repaired name.
FIRST_COLUMN = "Position km"
SPEED_COLUMN = "Speed km/h km/h"


def _out(layout: str, *columns: str) -> list[str]:
    return [*columns, "layout"] if layout == "mixed" else [*columns]

# Private-use characters stand for an escaped delimiter and backslash while a
# line is split.
_DELIMITER_MARK, _BACKSLASH_MARK = "", ""


def split_fields(line: Column, delimiter: str = "\t") -> Column:
    """Fields of a line: backslash escapes undone, ``"`` and ``;`` removed.

    Escapes are rare, so only lines with a backslash take the longer way.
    """
    cleaned = '"' if delimiter == ";" else '";'

    def without(text_: Column, characters: str) -> Column:
        for c in characters:
            text_ = F.replace(text_, F.lit(c), F.lit(""))
        return text_

    marked = F.replace(line, F.lit("\\\\"), F.lit(_BACKSLASH_MARK))
    marked = F.replace(marked, F.lit("\\" + delimiter), F.lit(_DELIMITER_MARK))
    marked = F.replace(marked, F.lit("\\"), F.lit(""))
    restored = "\\" + ("" if delimiter == ";" else delimiter)
    escaped = F.transform(
        F.split(without(marked, cleaned), delimiter),
        lambda f: F.translate(f, _BACKSLASH_MARK + _DELIMITER_MARK, restored),
    )
    return F.when(line.contains("\\"), escaped).otherwise(F.split(without(line, cleaned), delimiter))


def _blank(field: Column) -> Column:
    return field.rlike(r"^[\s\x1c-\x1f\x85\xa0]*$")


def _may_be_blank(line: Column, delimiter: str) -> Column:
    """Whether the first field of a line can be blank; told without splitting the line."""
    return line.rlike(rf'^[\s";\\\x1c-\x1f\x85\xa0]*({delimiter}|$)')


def _field(fields: Column, i: int) -> Column:
    return F.get(fields, F.lit(i))


# --- one row per file -------------------------------------------------------


# A byte-order mark as such, and as its three bytes are read in ISO-8859-1.
_BYTE_ORDER_MARK = "^(\ufeff|\u00ef\u00bb\u00bf)"


def content_lines(content: Column) -> Column:
    """Lines of a file by any line break, as a reader of lines gives them.

    A byte-order mark is no part of the first line, and a final line break
    ends the last line without beginning another.
    """
    plain = F.regexp_replace(content, _BYTE_ORDER_MARK, "")
    unix = F.replace(F.replace(plain, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    unix = F.when(plain.contains("\r"), unix).otherwise(plain)
    ended = F.when(unix.endswith("\n"), F.left(unix, F.length(unix) - 1)).otherwise(unix)
    return F.when(unix == "", F.array().cast("array<string>")).otherwise(F.split(ended, "\n"))


# What can be said of a file.
FILE_OK, NO_HEADER_END, NO_COLUMN_ROW, NO_SERIES_NAME = "ok", "no header end", "no column row", "no series name"


def _outcome(layout: str) -> Column:
    """What the header of a file (``_at``, ``columns`` and header columns) lets it be."""
    no_end = F.lit(False) if layout == "positional" else F.col("_at").isNull()
    no_name = F.trim(F.coalesce(F.col("meting_serie_naam"), F.lit(""))) == ""
    return (
        F.when(no_end, NO_HEADER_END)
        .when(F.col("columns").isNull(), NO_COLUMN_ROW)
        .when(no_name, NO_SERIES_NAME)
        .otherwise(FILE_OK)
    )


def _positional(outcome: Column, columns: Column, series: Column) -> Column:
    """Whether a file with this keyed outcome is one of the positional layout, by that layout's columns and series."""
    named = F.trim(F.regexp_replace(F.coalesce(F.get(columns, F.lit(0)), F.lit("")), '"', "")) == FIRST_COLUMN
    return (outcome != FILE_OK) & named & (F.trim(F.coalesce(series, F.lit(""))) != "")


def _layout_name(positional: Column) -> Column:
    return F.when(positional, F.lit("positional")).otherwise(F.lit("keyed"))


def _fields(line: Column, layout: str, delimiter: str) -> Column:
    """Fields of a line; of mixed layouts by the row's ``layout``."""
    if layout == "positional":
        return F.split(line, "\t")
    keyed = split_fields(line, delimiter)
    return keyed if layout == "keyed" else F.when(F.col("layout") == "positional", F.split(line, "\t")).otherwise(keyed)


# The header end is looked for among this many lines before the whole file.
_FIRST_LINES = 200


def _located_files(files: DataFrame, layout: str, delimiter: str) -> DataFrame:
    """One row per file: header columns, column names, their line ``_at`` and all ``_lines``.

    Without the blank row that ends a header, ``_at`` and the header are NULL.
    """
    # One-element inline: the lines are split once, later steps do not repeat it.
    split = F.struct("bestands_url", content_lines(F.col("content")).alias("_lines"))
    lines = files.select(F.inline(F.array(split)))

    def fields_of(line: Column) -> Column:
        return F.split(line, "\t") if layout == "positional" else split_fields(line, delimiter)

    if layout == "positional":
        head = {n: _field(fields_of(F.get("_lines", F.lit(i))), 1) for i, n in POSITIONAL_HEADER.items()}
        rows = lines.withColumn("_at", F.lit(POSITIONAL_COLUMN_LINE))
    else:

        def blank_at(part: Column) -> Column:
            blank = lambda v: F.when(_may_be_blank(v, delimiter), _blank(_field(fields_of(v), 0))).otherwise(False)
            return F.array_position(F.transform(part, blank), F.lit(True))

        early = F.nullif(blank_at(F.slice("_lines", 1, _FIRST_LINES)), F.lit(0))
        at = F.coalesce(early, blank_at(F.col("_lines"))).cast("int")
        rows = lines.withColumn("_at", F.nullif(at, F.lit(0)))
        entries = F.transform(F.slice("_lines", F.lit(1), F.col("_at") - 1), fields_of)
        rows = rows.withColumn("_entries", entries)

        def last_value(key: str) -> Column:
            named = F.filter("_entries", lambda f: F.get(f, F.lit(0)) == key)
            return _field(F.try_element_at(named, F.lit(-1)), 1)

        head = {name: last_value(key) for key, name in HEADER_KEYS.items()}
    rows = rows.withColumns({**head, "columns": fields_of(F.get("_lines", F.col("_at")))})
    return _by_file(rows) if layout == "mixed" else rows


def _by_file(rows: DataFrame) -> DataFrame:
    """Files located by the keyed rules, with the positional ones put in their place where only these fit."""
    line = lambda i: F.split(F.get("_lines", F.lit(i)), "\t")
    head = {name: _field(line(i), 1) for i, name in POSITIONAL_HEADER.items()}
    columns = line(POSITIONAL_COLUMN_LINE)
    chosen = _positional(_outcome("keyed"), columns, head["meting_serie_naam"])
    rows = rows.withColumn("layout", _layout_name(chosen))
    placed = {**head, "columns": columns, "_at": F.lit(POSITIONAL_COLUMN_LINE)}
    return rows.withColumns(
        {name: F.when(F.col("layout") == "positional", value).otherwise(F.col(name)) for name, value in placed.items()}
    )


def file_headers(files: DataFrame, layout: str = "keyed", delimiter: str = "\t") -> DataFrame:
    """Header, column names and outcome, one row per file of ``files`` (bestands_url, content)."""
    located = _located_files(files, layout, delimiter)
    return located.select(*_out(layout, "bestands_url", *HEADER_COLUMNS, "columns"), _outcome(layout).alias("outcome"))


def parse_files(files: DataFrame, layout: str = "keyed", delimiter: str = "\t") -> DataFrame:
    """Body rows of ``files`` (bestands_url, content)."""
    # The header is a column of its own by now: were it taken from the lines
    # next to posexplode, each body row would carry all lines of its file.
    rows = _located_files(files, layout, delimiter)
    kept = _out(layout, "bestands_url", *HEADER_COLUMNS, "columns", "_at")
    body = rows.select(*kept, F.posexplode("_lines").alias("_i", "_line")).where(F.col("_i") > F.col("_at"))
    fields = _fields(F.col("_line"), layout, delimiter)
    return body.withColumns({"line_no": F.col("_i").cast("bigint"), "fields": fields}).select(*_out(layout, *_OUT))


# --- one row per line -------------------------------------------------------


def number_lines(
    lines: DataFrame, broadcast_rows: int = 4 * BROADCAST_ROWS, per_folder: bool = False
) -> DataFrame:
    """Turn (file, block, seq, value) into lines of ``bestands_url`` numbered from 0.

    ``file`` is the encoded path that text scans report, ``block`` the start of
    the file split; ``seq`` grows within a split by one per line. Only the line
    counts of the splits are summed per file. With ``per_folder`` the files of a
    folder, in the order of their names, are one file with the folder's path.
    """
    owner = F.regexp_replace("file", "/[^/]*$", "") if per_folder else F.col("file")
    per_block = lines.groupBy("file", "block").agg(F.count("*").alias("_n"), F.min("seq").alias("_seq0"))
    order = Window.partitionBy(owner).orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(order), F.lit(0))
    # A plus sign stands for itself in a path, the decoder would make it a space.
    path = F.url_decode(F.replace(owner, F.lit("+"), F.lit("%2B")))
    bases = settle(
        per_block.select("file", "block", "_seq0", before.alias("_base"), path.alias("bestands_url")), "line-bases"
    )
    return skew_safe_join(
        lines, bases, ["file", "block"], spread_by=["seq"], broadcast_rows=broadcast_rows
    ).select(
        "bestands_url",
        (F.col("_base") + F.col("seq") - F.col("_seq0")).alias("line_no"),
        "value",
    )


def _header_ends(lines: DataFrame, delimiter: str) -> DataFrame:
    """The line ``_end`` that ends each file's header, NULL where no line does; one stored row per file.

    Only lines that may begin with a blank field are split.
    """
    blank = F.when(_may_be_blank(F.col("value"), delimiter), _blank(_field(split_fields(F.col("value"), delimiter), 0)))
    ends = lines.groupBy("bestands_url").agg(F.min(F.when(blank, F.col("line_no"))).alias("_end"))
    return settle(ends, "header-ends")


def _top_lines(
    lines: DataFrame, ends: DataFrame, delimiter: str, broadcast_rows: int, rows_per_task: int
) -> DataFrame:
    """Split lines up to the column row, with the line ``_end`` that ends the header."""
    top = skew_safe_join(
        lines,
        ends.where(F.col("_end").isNotNull()),
        ["bestands_url"],
        condition=F.col("line_no") <= F.col("_end") + 1,
        spread_by=["line_no"],
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
    )
    return top.withColumn("fields", split_fields(F.col("value"), delimiter)).drop("value")


# Header lines that a task sorts at once.
SORT_ROWS = 200_000


def _dealt_tops(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` header lines ``rows`` in tasks of about ``SORT_ROWS``, lines of a file mostly together.

    Texts are aggregated by sorting, and a task of a scan may hold the headers of any number of files.
    """
    if n <= SORT_ROWS:
        return rows
    parts = max(-(-n // SORT_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(parts, F.col("bestands_url"), F.call_function("div", F.col("line_no"), F.lit(1024)))


def _n_top_lines(ends: DataFrame) -> int:
    return ends.agg(F.coalesce(F.sum(F.col("_end") + 2), F.lit(0))).first()[0]


def header_entries(
    lines: DataFrame,
    delimiter: str = "\t",
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Header of each file as (bestands_url, key, value); the last of a repeated key counts."""
    ends = _header_ends(lines, delimiter)
    rows = _top_lines(lines, ends, delimiter, broadcast_rows, rows_per_task)
    return (
        _dealt_tops(rows, _n_top_lines(ends)).where(F.col("line_no") < F.col("_end"))
        .groupBy("bestands_url", _field(F.col("fields"), 0).alias("key"))
        .agg(F.max_by(_field(F.col("fields"), 1), F.col("line_no")).alias("value"))
    )


def _fields_of_lines(lines: DataFrame, layout: str, delimiter: str) -> DataFrame:
    return lines.select("bestands_url", "line_no", _fields(F.col("value"), layout, delimiter).alias("fields"))


def line_headers(
    lines: DataFrame,
    layout: str = "keyed",
    delimiter: str = "\t",
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Header, column names, the line of these and outcome, one stored row per file.

    Line numbers have no gap up to the column row, which follows the blank row.
    A file without a line is not among ``lines`` and so has no row here.
    """
    if layout == "mixed":
        ways = [line_headers(lines, way, delimiter, broadcast_rows, rows_per_task) for way in ("keyed", "positional")]
        return settle(_chosen_headers(*ways), "headers")
    number, fields = F.col("line_no"), F.col("fields")
    if layout == "positional":
        at = F.when(number == POSITIONAL_COLUMN_LINE, number)
        picks = [F.max(F.when(number == i, _field(fields, 1))).alias(n) for i, n in POSITIONAL_HEADER.items()]
        top = lines.where(number <= POSITIONAL_COLUMN_LINE)
        rows, n = _fields_of_lines(top, layout, delimiter), top.count()
    else:
        ends = _header_ends(lines, delimiter)
        rows, n = _top_lines(lines, ends, delimiter, broadcast_rows, rows_per_task), _n_top_lines(ends)
        at = F.when(number > F.col("_end"), number)
        in_header = number < F.col("_end")
        picks = [
            F.max_by(_field(fields, 1), F.when(in_header & (_field(fields, 0) == key), number)).alias(name)
            for key, name in HEADER_KEYS.items()
        ]
    heads = _dealt_tops(rows, n).groupBy("bestands_url").agg(*picks, F.min(at).alias("_at"), F.min_by(fields, at).alias("columns"))
    if layout != "positional":
        # A header that ends with the file has a place for the column row, but no such row.
        heads = ends.join(heads.drop("_at"), "bestands_url", "left").withColumn("_at", F.col("_end") + 1).drop("_end")
    return settle(heads.withColumn("outcome", _outcome(layout)), "headers")


def _chosen_headers(keyed: DataFrame, positional: DataFrame) -> DataFrame:
    """Of two readings of the same files, one row each, the one that fits."""
    named = ["_at", "columns", "outcome", *HEADER_COLUMNS]
    other = positional.select("bestands_url", F.struct(*named).alias("_other"))
    both = keyed.select("bestands_url", F.struct(*named).alias("_own")).join(other, "bestands_url")
    chosen = _positional(F.col("_own.outcome"), F.col("_other.columns"), F.col("_other.meting_serie_naam"))
    both = both.withColumn("layout", _layout_name(chosen))

    def value(name: str) -> Column:
        return F.when(F.col("layout") == "positional", F.col(f"_other.{name}")).otherwise(F.col(f"_own.{name}"))

    return both.select("bestands_url", "layout", *[value(n).alias(n) for n in named])


def parse_lines(
    lines: DataFrame,
    layout: str = "keyed",
    delimiter: str = "\t",
    headers: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Body rows of ``lines`` (bestands_url, line_no, value).

    ``headers`` is what :func:`line_headers` gives for the same lines, if it is
    at hand.
    """
    if headers is None:
        headers = line_headers(lines, layout, delimiter, broadcast_rows, rows_per_task)
    # Which fields a line has is known before it meets its header, but for mixed layouts.
    mixed = layout == "mixed"
    rows = skew_safe_join(
        lines.select("bestands_url", "line_no", "value") if mixed else _fields_of_lines(lines, layout, delimiter),
        headers.where(F.col("_at").isNotNull()),
        ["bestands_url"],
        condition=F.col("line_no") > F.col("_at"),
        spread_by=["line_no"],
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
    )
    rows = rows.withColumn("fields", _fields(F.col("value"), layout, delimiter)) if mixed else rows
    return rows.select(*_out(layout, *_OUT))


# --- cleaned copies ---------------------------------------------------------


def _with_speed_name(names: Column) -> Column:
    return F.transform(names, lambda f, i: F.when(i == 10, F.lit(SPEED_COLUMN)).otherwise(f))


def repair_header(fields: Column) -> Column:
    """Rename the eleventh column of a column row; other rows stay."""
    return F.when(_field(fields, 0) == FIRST_COLUMN, _with_speed_name(fields)).otherwise(fields)


def normalized_line(lines: DataFrame, delimiter: str = "\t", repair: bool = False) -> DataFrame:
    """Each line with cleaned fields, joined by semicolons, backslashes doubled.

    ``repair`` also renames the speed column of column rows.
    """
    fields = split_fields(F.col("value"), delimiter)
    escaped = F.transform(
        repair_header(fields) if repair else fields, lambda f: F.replace(f, F.lit("\\"), F.lit("\\\\"))
    )
    return lines.withColumn("value", F.concat_ws(";", escaped))


# --- typed rows -------------------------------------------------------------


def import_rows(
    rows: DataFrame,
    read_at: datetime.datetime,
    layout: str = "keyed",
) -> DataFrame:
    """Parsed rows as typed measurements plus ``line_no`` and ``errors``.

    ``errors`` names the columns whose text is not empty but has no value of
    the column type, and the texts that are too long. An empty text is NULL. Rows of mixed layouts are
    read each by its ``layout``.
    """
    f = {i: _field(F.col("fields"), i) for i in range(22)}

    def by_layout(keyed: Column, positional: Column) -> Column:
        if layout == "mixed":
            return F.when(F.col("layout") == "positional", positional).otherwise(keyed)
        return keyed if layout == "keyed" else positional

    photos = [by_layout(*ways) for ways in zip(text.photo_names(F.slice("fields", 17, 6)), [f[16], f[17]], strict=True)]
    # Body field numbers of the stored columns.
    numbers = {
        "kmp": text.to_decimal(f[0], 10, 4),
        "rl": text.to_int(f[2]),
        "rlmin": text.to_int(f[3]),
        "rlmax": text.to_int(f[4]),
        "rlstddev": text.to_int(f[5]),
        "rlprocpass": text.to_int(f[6]),
        "temperatuur": text.to_int(f[8]),
        "vochtigheid": text.to_int(f[9]),
        "snelheid": text.to_decimal(f[10], 6, 2),
        "longitude_start": text.to_decimal(f[12], 12, 9),
        "latitude_start": text.to_decimal(f[13], 12, 9),
        "longitude_eind": text.to_decimal(f[14], 12, 9),
        "latitude_eind": text.to_decimal(f[15], 12, 9),
    }
    source = {
        "kmp": 0, "rl": 2, "rlmin": 3, "rlmax": 4, "rlstddev": 5, "rlprocpass": 6, "temperatuur": 8,
        "vochtigheid": 9, "snelheid": 10, "longitude_start": 12, "latitude_start": 13,
        "longitude_eind": 14, "latitude_eind": 15,
    }
    typed = rows.withColumns(
        {
            **numbers,
            "oid": F.xxhash64("bestands_url", "line_no"),
            "tijdstip_meting": by_layout(measure_time(f[1]), measure_time_legacy(f[1])),
            "marker": f[7],
            "reference": f[11],
            "naam_foto1": photos[0],
            "naam_foto2": photos[1],
            "inleesdatum": stamp(read_at),
        }
    )
    shown_time = by_layout(F.when(f[1].contains("/"), iso_text(F.col("tijdstip_meting"))).otherwise(f[1]), f[1])
    typed = typed.withColumn("tijdstip_meting_tekst", shown_time)
    faults = {c: F.col(c).isNull() & (F.trim(f[i]) != "") for c, i in source.items()}
    faults |= {c: F.col(c).isNull() for c in ("tijdstip_meting", "meting_serie_naam")}
    for c, n in TEXT_LIMITS.items():
        too_long = F.length(c) > n
        faults[c] = faults[c] | too_long if c in faults else too_long
    # Nearly all rows are sound; only the others build the list of names.
    # Plain string functions here would join all casts in one generated method,
    # too large to be compiled, and take twice as long.
    named = F.array_compact(F.array(*[F.when(fault, F.lit(c)) for c, fault in faults.items()]))
    none = F.array().cast("array<string>")
    typed = typed.withColumn("errors", F.when(reduce(Column.__or__, faults.values()), named).otherwise(none))
    # One-element inline: a filter on ``errors`` stops here and does not repeat the casts.
    return typed.select(F.inline(F.array(F.struct(*MEASUREMENT_RAW.names, "line_no", "errors"))))


def accepted(imported: DataFrame, *more: str) -> DataFrame:
    """Sound rows, with the columns ``more``; file and ``line_no`` are their exact key."""
    return imported.where(F.size("errors") == 0).select(*MEASUREMENT_RAW.names, "line_no", *more)


def rejected(imported: DataFrame) -> DataFrame:
    return imported.where(F.size("errors") > 0)


# --- the combined table of 2024 ---------------------------------------------

# The tag columns and the number of columns kept.
TAGS = ["meting_serie_naam", "ident8", "markering"]
KEPT_COLUMNS = 19


def series_parts(series: Column) -> list[Column]:
    """Road id and marking cut from the series name."""
    return [F.substring(series, 1, 8), F.substring(series, 10, 2)]


def _told_apart(names: Column) -> Column:
    """Names of which a repeated one gets its number behind it: a, b, a (2)."""

    def numbered(name: Column, i: Column) -> Column:
        n = F.size(F.filter(F.slice(names, F.lit(1), i + 1), lambda other: other.eqNullSafe(name)))
        return F.when(n > 1, F.concat(name, F.lit(" ("), n.cast("string"), F.lit(")"))).otherwise(name)

    return F.transform(names, numbered)


def _tagged_names(columns: Column) -> Column:
    kept = KEPT_COLUMNS - len(TAGS)
    return _told_apart(F.concat(F.array(*[F.lit(t) for t in TAGS]), F.slice(_with_speed_name(columns), 1, kept)))


def tag_rows(rows: DataFrame) -> DataFrame:
    """Body rows with series name, road id and marking in front, as names and texts."""
    return rows.select(
        "bestands_url", "line_no", _tagged_names(F.col("columns")).alias("names"), _tagged_texts().alias("texts")
    )


def _tagged_texts() -> Column:
    series = F.col("meting_serie_naam")
    return F.concat(F.array(series, *series_parts(series)), F.slice("fields", 1, KEPT_COLUMNS - len(TAGS)))


def column_names(layouts: DataFrame, most_columns: int = 1000) -> list[str]:
    """The different names in ``layouts`` (names), in the order of their first places.

    Only they reach the driver, the schema needs them. More than ``most_columns`` of them are refused: then
    some column row is none, and :func:`line_headers` tells which.
    """
    named = layouts.select("names").distinct().select(F.posexplode("names").alias("at", "name"))
    found = named.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").limit(most_columns + 1).collect()
    if len(found) > most_columns:
        raise ValueError(f"more than {most_columns} different column names")
    return [r["name"] for r in found]


def widen(tagged: DataFrame, layouts: DataFrame, most_columns: int = 1000) -> DataFrame:
    """One text column per name in ``layouts`` (names); NULL where a file lacks it."""

    def value(name: str) -> Column:
        at = F.array_position("names", F.lit(name))
        return F.when(at > 0, F.get("texts", (at - 1).cast("int")))

    names = column_names(layouts, most_columns)
    return tagged.select("bestands_url", "line_no", *[value(n).alias(n) for n in names])


def nonzero_text(rows: DataFrame, column: str = "RL") -> DataFrame:
    """Rows whose text is not exactly ``0``; NULL and other spellings stay."""
    return rows.where(~F.col(column).eqNullSafe(F.lit("0")))


def taken_2024(rows: DataFrame) -> DataFrame:
    """Rows of files whose name begins with the folder name and whose stem is the series name."""
    path = F.col("bestands_url")
    name = F.substring_index(path, "/", -1)
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return rows.where(text.rejection_2024(name, folder, F.col("meting_serie_naam")).isNull())


def combined_2024(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """All body rows of taken files in one wide text table.

    ``headers`` has one row per file, so which files are taken, their column names and the places of these
    are found per file, without reading the body; body rows carry the places only.
    """
    files = taken_2024(headers).select("bestands_url", _tagged_names(F.col("columns")).alias("names"))
    files = settle(files, "layouts")
    names = column_names(files)
    places = F.array(*[(F.array_position("names", F.lit(n)) - 1).cast("int") for n in names]).cast("array<int>")
    placed = files.select("bestands_url", places.alias("_places"))
    taken = skew_safe_join(rows, placed, ["bestands_url"], spread_by=["line_no"])
    # One-element inline: the texts are put together once, not for each column.
    tagged = taken.select(F.inline(F.array(F.struct("bestands_url", "line_no", "_places", _tagged_texts().alias("_texts")))))
    wide = tagged.select("bestands_url", "line_no", *[_placed_text(i).alias(n) for i, n in enumerate(names)])
    return nonzero_text(wide) if "RL" in names else wide


def _placed_text(i: int) -> Column:
    """The text of the i-th column, NULL where the file lacks it."""
    place = F.get("_places", F.lit(i))
    return F.when(place >= 0, F.get("_texts", place))


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column that one lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
