"""Survey tables derived from the given star-schema tables.

The given tables hold no road data. Each function maps one of them, row by
row, to a survey table, so every query grows with its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.functions.times import iso_text
from lanelux.schemas import FILE_LOG, HEADER_KEYS, MEASUREMENT_RAW, POSITIONAL_HEADER, QUALITY_CLASS

SURVEY_YEAR = 2024
LOG_YEAR = 1997
WATERMARK = "2024-01-15"

# Fixture values: class bands, general and for primary roads.
_CLASS_TEXTS = [
    ("A", "laag", "R1", "slecht", "vervangen"),
    ("B", "matig", "R2", "matig", "opvolgen"),
    ("C", "goed", "R3", "goed", "geen"),
    ("D", "hoog", "R4", "zeer goed", "geen"),
]
_BANDS = [(0, 49), (50, 99), (100, 199), (200, 9999)]
_BANDS_P = [(0, 79), (80, 119), (120, 179), (180, 9999)]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _decimal(value: Column, precision: int, scale: int) -> Column:
    return value.cast(f"decimal({precision},{scale})")


def _tenths(number: Column, unit: str, precision: int, scale: int) -> Column:
    """``number`` steps of ``unit`` without going through a floating value."""
    return _decimal(number.cast("decimal(18,0)") * F.lit(unit).cast("decimal(12,9)"), precision, scale)


def road(number: Column) -> Column:
    digit = F.when(number % 2 == 0, "1").otherwise("2")
    return F.concat(F.lit("N"), F.lpad(number.cast("string"), 6, "0"), digit)


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imported measurements from the events, with the road id as extra column."""
    e = read(spark, sf_dir, "events")
    i, u = F.col("event_id"), F.col("user_id")
    marking = (
        F.when(F.col("event_type") == "view", "M1")
        .when(F.col("event_type") == "click", "M2")
        .when(F.col("event_type") == "purchase", "M1R")
        .when(F.col("event_type") == "signup", "M2R")
        .when(F.col("event_type") == "error", "M3")
    )
    rl = F.floor("value").cast("int")
    lon = _decimal(F.lit("2.6").cast("decimal(12,9)") + _tenths((i * 7919) % 3000, "0.001", 12, 9), 12, 9)
    lat = _decimal(F.lit("50.7").cast("decimal(12,9)") + _tenths((i * 31) % 700, "0.001", 12, 9), 12, 9)
    lon_end = _decimal(lon + _tenths(i % 20, "0.0001", 12, 9), 12, 9)
    columns = {
        "oid": i,
        "bestands_url": F.concat(F.lit("temp/N"), F.lpad(u.cast("string"), 6, "0"), F.lit(" M1.xls")),
        "toestel": F.concat(F.lit("toestel "), (u % 4).cast("string")),
        "meting_serie_naam": F.concat(road(u), F.lit(" "), marking),
        "rijstrook": F.concat(F.lit("R"), (u % 3 + 1).cast("string")),
        "toestel_zijde": F.when(u % 2 == 0, "L").otherwise("R"),
        "markering": marking,
        "locatieomschrijving": F.concat(F.lit("traject "), (u % 50).cast("string")),
        "operator_naam": F.concat(F.lit("operator "), (u % 7).cast("string")),
        "kmp": _tenths((i * 37) % 1000, "0.1", 10, 4),
        "tijdstip_meting_tekst": iso_text(F.col("ts")),
        "tijdstip_meting": F.col("ts"),
        "rl": rl,
        "rlmin": (rl - F.floor(rl / 5)).cast("int"),
        "rlmax": (rl + i % 40).cast("int"),
        "rlstddev": (i % 17).cast("int"),
        "rlprocpass": (i % 101).cast("int"),
        "marker": F.when(i % 50 == 0, "Obstakel").otherwise("-"),
        "temperatuur": (i % 35 - 5).cast("int"),
        "vochtigheid": (40 + i % 55).cast("int"),
        "snelheid": _tenths((i * 13) % 9000, "0.01", 6, 2),
        "reference": F.concat(F.lit("ref "), (i % 10).cast("string")),
        "longitude_start": lon,
        "latitude_start": lat,
        "longitude_eind": lon_end,
        "latitude_eind": lat,
        "naam_foto1": F.when(i % 4 == 0, F.concat(F.lit("b"), i.cast("string"), F.lit(".jpg"))).otherwise("-"),
        "naam_foto2": F.when(i % 8 == 0, F.concat(F.lit("d"), i.cast("string"), F.lit(".jpg"))).otherwise("-"),
        "inleesdatum": F.col("ts").cast("date").cast("timestamp_ntz"),
    }
    return e.select(*[columns[n].alias(n) for n in MEASUREMENT_RAW.names], road(u).alias("ident8"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of 10 km from the parts, boundaries shared."""
    p, key = read(spark, sf_dir, "part"), F.col("p_partkey")
    begin = (key % 10) * 10
    codes = ["111", "122", "113", "124", "117", "195"]
    code = F.get(F.array(*[F.lit(c) for c in codes]), (key % 6).cast("int"))
    category = F.get(F.array(*[F.lit(c) for c in ("H", "P1", "P2", "S")]), (key % 4).cast("int"))
    return p.select(
        key.cast("int").alias("id"),
        road(F.call_function("div", key, F.lit(10))).alias("ident8"),
        _decimal(begin, 38, 8).alias("beginpositie"),
        _decimal(begin + 10, 38, 8).alias("eindpositie"),
        F.concat(F.lit("Regio D"), code, F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("gebied"),
        F.when(key % 7 == 0, "false").otherwise("true").alias("eigenbeheer"),
        category.alias("wegcategorie"),
    )


def _class_rows(spark: SparkSession, bands: list[tuple[int, int]]) -> DataFrame:
    rows = ", ".join(str((*texts, *limits)) for texts, limits in zip(_CLASS_TEXTS, bands))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(QUALITY_CLASS.names)})").to(QUALITY_CLASS)


def classes(spark: SparkSession) -> DataFrame:
    return _class_rows(spark, _BANDS)


def classes_p(spark: SparkSession) -> DataFrame:
    return _class_rows(spark, _BANDS_P)


def file_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file log from the orders."""
    o = read(spark, sf_dir, "orders")
    key, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    stem = F.concat(F.lit("N"), F.lpad(customer.cast("string"), 6, "0"), F.lit(" M1"))
    folder_number = customer + F.when(key % 10 == 1, 1).otherwise(0)
    columns = {
        "oid": key,
        "drive_file_name": F.concat(stem, F.lit(".xls")),
        "drive_file_id": F.concat(F.lit("id"), key.cast("string")),
        "drive_folder_name": F.concat(F.lit("N"), F.lpad(folder_number.cast("string"), 6, "0")),
        "drive_folder_id": F.concat(F.lit("map"), folder_number.cast("string")),
        "measure_series_name": F.when(key % 7 == 3, F.concat(stem, F.lit(" bis"))).otherwise(stem),
        "datetime_utc_read": F.col("o_orderdate"),
        "name_conform": F.when(status == "F", True).when(status == "O", False),
        "completed_step": F.when(status == "P", 3).otherwise(4),
        "report_year": F.year("o_orderdate"),
    }
    return o.select(*[columns[n].cast(t).alias(n) for n, t in ((f.name, f.dataType) for f in FILE_LOG)])


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing holds every file."""
    return file_log(spark, sf_dir)


def logged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log holds the files that are checked."""
    return file_log(spark, sf_dir).where(F.col("completed_step") == 4)


# --- raw survey text --------------------------------------------------------

# Fixture values: column names of the body.
BODY_COLUMNS = [
    "Position km", "Date", "RL", "RL min", "RL max", "RL stddev", "RL pass", "Marker", "Temp", "Hum",
    "Speed", "Reference", "Lon start", "Lat start", "Lon end", "Lat end",
    "Photo 1", "Photo 2", "Photo 3", "Photo 4", "Photo 5", "Photo 6",
]


def _comma(value: Column) -> Column:
    return F.replace(value.cast("string"), F.lit("."), F.lit(","))


def body_fields(delimiter_escape: str | None = "\t") -> list[Column]:
    """The 22 texts of a body line, with noise that the parser has to undo."""
    i, ts = F.col("oid"), F.col("tijdstip_meting_tekst")
    day_first = F.concat(
        F.substring(ts, 9, 2), F.lit("/"), F.substring(ts, 6, 2), F.lit("/"), F.substring(ts, 1, 4), F.substring(ts, 11, 9)
    )
    time = F.when(i % 3 == 0, ts).otherwise(day_first) if delimiter_escape else day_first
    marker = F.col("marker")
    if delimiter_escape:
        marker = F.when(i % 50 == 0, F.lit('Obst"akel;' if delimiter_escape == "\t" else 'Obst"akel')).otherwise(
            F.when(i % 50 == 1, F.lit(f"a\\{delimiter_escape}b\\\\c")).otherwise(marker)
        )
    number = i.cast("string")
    photo = F.concat(F.lit("a"), number, F.lit(".jpgb"), number, F.lit(".jpg"))
    second = F.concat(F.lit("c"), number, F.lit(".jpgd"), number, F.lit(".jpg"))
    third = F.concat(F.lit("e"), number, F.lit(".jpgf"), number, F.lit(".jpg"))
    if delimiter_escape:
        slots = [
            F.lit("-"),
            F.when(i % 4 == 0, photo).otherwise("-"),
            F.lit("-"),
            F.when(i % 8 == 0, second).otherwise("-"),
            F.when(i % 16 == 0, third).otherwise("-"),
            F.lit("-"),
        ]
    else:
        slots = [F.col("naam_foto1"), F.col("naam_foto2"), *[F.lit("-")] * 4]
    whole = [F.col(c).cast("string") for c in ("rl", "rlmin", "rlmax", "rlstddev", "rlprocpass")]
    return [
        _comma(F.col("kmp")),
        time,
        *whole,
        marker,
        F.col("temperatuur").cast("string"),
        F.col("vochtigheid").cast("string"),
        _comma(F.col("snelheid")),
        F.col("reference"),
        *[_comma(F.col(c)) for c in ("longitude_start", "latitude_start", "longitude_eind", "latitude_eind")],
        *slots,
    ]


def survey_lines(measured: DataFrame, layout: str = "keyed", delimiter: str = "\t") -> DataFrame:
    """Numbered text lines, one file per series, folder named like the road.

    Header lines come from one row per series; a body line's number follows
    the measurement id. The keyed header repeats one key, the last one counts.
    """
    series = F.col("meting_serie_naam")
    url = F.concat(F.lit("survey/"), F.substring_index(series, " ", 1), F.lit("/"), series, F.lit(".xls"))
    heads = measured.groupBy(series).agg(
        *[F.max(c).alias(c) for c in HEADER_KEYS.values() if c != "meting_serie_naam"]
    )

    def joined(*parts: Column) -> Column:
        return F.concat_ws(delimiter, *parts)

    if layout == "positional":
        texts = [F.lit(f"regel {n}{delimiter}-") for n in range(18)]
        for n, name in POSITIONAL_HEADER.items():
            texts[n] = joined(F.lit(f"kop {n}"), F.col(name))
        body = joined(*body_fields(None))
    else:
        texts = [joined(F.lit("Remarks:"), F.lit("oud"))]
        texts += [joined(F.lit(key), F.col(name)) for key, name in HEADER_KEYS.items()]
        texts.append(joined(F.lit(" "), F.lit("")))
        body = joined(*body_fields(delimiter))
    texts.append(joined(*[F.lit(c) for c in BODY_COLUMNS]))
    header = heads.select(url.alias("bestands_url"), F.posexplode(F.array(*texts)).alias("line_no", "value"))
    rows = measured.select(url.alias("bestands_url"), (F.col("oid") + 100).alias("line_no"), body.alias("value"))
    return header.select("bestands_url", F.col("line_no").cast("bigint"), "value").unionByName(rows)


def _broken(lines: DataFrame, block: Column) -> DataFrame:
    """Every fourth kind of file without header end, column row or series name, or with a byte-order mark."""
    kind, number, series = block % 8, F.col("line_no"), F.col("value").startswith("Measure Series Name:")
    blank = len(HEADER_KEYS) + 1
    kept = (
        F.when(kind == 1, number != blank)
        .when(kind == 3, number <= blank)
        .when(kind == 5, ~series)
        .when(kind == 7, number != 0)
        .otherwise(True)
    )
    marked = F.when((kind == 7) & (number == 1), F.concat(F.lit("\ufeff"), "value")).otherwise(F.col("value"))
    return lines.where(kept).withColumn("value", marked)


def write_survey_files(
    measured: DataFrame, path: str, rows_per_file: int = 1000, broken: bool = False
) -> None:
    """Real survey files of at most ``rows_per_file`` measurements each.

    One file per block of measurement ids, header first. Each file is one row
    set of known size, so writing it in one task is safe.
    """
    block = F.call_function("div", F.col("oid"), F.lit(rows_per_file))
    blocked = measured.drop("meting_serie_naam").withColumns(
        {
            "meting_serie_naam": F.concat(F.lit("B"), F.lpad(block.cast("string"), 7, "0"), F.lit(" M1")),
            "markering": F.lit("M1"),
        }
    )
    lines = survey_lines(blocked).withColumn("bestand", F.regexp_extract("bestands_url", r"([^/]+)\.xls$", 1))
    if broken:
        lines = _broken(lines, F.substring("bestand", 2, 7).cast("int"))
    (
        lines.repartition("bestand")
        .sortWithinPartitions("bestand", "line_no")
        .select("bestand", "value")
        .write.partitionBy("bestand")
        .text(path)
    )
