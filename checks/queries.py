"""Every operator as a query over the given tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.functions import geo, text, times
from lanelux.operators import ledger, points, segments, shares, sinks, survey
from lanelux.operators.joins import band_join
from lanelux.operators.order import numbered
from lanelux.plans import adapters as given
from lanelux.plans import reports
from lanelux.plans.located import update_located
from lanelux.plans.pipeline import Store, append_new_lines
from lanelux.schemas import LAMBERT72_SRID, PROVINCES
from lanelux.session import file_system, scratch_path, settle
from lanelux.sources import catalog
from lanelux.sources.segment_files import read_segments
from lanelux.sources.survey_files import WHOLE_FILE_BYTES, file_lines, normalized_lines, read_survey, scan_survey
from lanelux.streaming.ingest import start_ingest

Query = Callable[[SparkSession, str], DataFrame]
READ_AT = datetime.datetime(2024, 12, 31, 12, 0, 0)
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines show the same value type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema
        ]
    )


def centimetres(value) -> F.Column:
    return F.round(value, 2)


# --- sources ----------------------------------------------------------------


def _tree(spark, sf) -> str:
    """A folder per road number and marking with one file each, and one file beside them."""
    root = scratch_path(spark, "tree")
    rows = given.measurements(spark, sf).select(
        (F.col("oid") % 20).alias("weg"), F.col("markering").alias("reeks"), F.col("oid").cast("string").alias("value")
    )
    rows.repartition("weg", "reeks").write.partitionBy("weg", "reeks").csv(root)
    rows.select("value").repartition(1).write.text(f"{root}/los")
    return root


@query
def file_catalog(spark, sf):
    """Files of one extension up to a depth; the file beside the tree has another."""
    root = _tree(spark, sf)
    csv = catalog.list_files(spark, root, ["csv"], depth=2)
    listed = csv.unionByName(catalog.list_files(spark, root, depth=1))
    above = F.element_at(F.split("parent_id", "/"), -2)
    return listed.select("parent_name", F.when(F.col("level") == 2, above).alias("above"), "level")


@query
def folder_catalog(spark, sf):
    """The folders of three names, by the number of the road: with files, with folders only, and empty."""
    root = _tree(spark, sf)
    for weg in range(0, 20, 3):
        system, place = file_system(spark, f"{root}/weg={weg}/leeg")
        system.mkdirs(place)
    weg = F.regexp_extract("folder_id", "weg=([0-9]+)", 1).alias("weg")
    held = catalog.list_folders(catalog.list_files(spark, root, ["csv"]))
    tree = catalog.list_tree(spark, root)
    found = []
    for way, folders in (("files", held), ("tree", catalog.tree_folders(tree))):
        for name in ("reeks=M1", "weg=3", "leeg"):
            found.append(catalog.find_folders(folders, name).select(F.lit(way).alias("way"), F.lit(name).alias("name"), weg))
    below = catalog.tree_folders(tree)
    top = catalog.find_folders(below, "weg=3").first()[0]
    under = catalog.find_folders(below, "leeg", parent_id=top)
    return survey.union_frames([*found, under.select(F.lit("under").alias("way"), F.lit("leeg").alias("name"), weg)])


@query
def folder_tree(spark, sf):
    """Every file and folder with its level, the folder above it, and how many files of each are found."""
    root = _tree(spark, sf)
    system, place = file_system(spark, f"{root}/leeg/dieper")
    system.mkdirs(place)
    tree = catalog.list_tree(spark, root)
    files = catalog.tree_files(tree, ["csv"]).select("parent_name", "level", F.lit(False).alias("is_folder"))
    folders = tree.where("is_folder").select("parent_name", "level", "is_folder", "name")
    above = F.when(F.col("level") > 0, F.col("parent_name"))
    return survey.union_frames([folders, files]).select("name", above.alias("above"), "level", "is_folder")


@query
def file_catalog_search(spark, sf):
    files = catalog.list_files(spark, _tree(spark, sf), ["csv"])
    hits = catalog.search_files(files, [".csv", "v", ".txt"], ["reeks=M1", "=M2R/"])
    weg, reeks = (F.regexp_extract("path", p, 1).alias(n) for p, n in (("weg=([0-9]+)/", "weg"), ("reeks=([^/]+)/", "reeks")))
    return hits.select(weg, reeks, "ending", "part")


def _lines(spark, sf, layout="keyed", delimiter="\t"):
    """Survey text as a stored table, so that it is made once and not per pass."""
    return settle(given.survey_lines(given.measurements(spark, sf), layout, delimiter), "survey-lines")


def _typed(rows, layout="keyed"):
    imported = survey.import_rows(rows, READ_AT, layout)
    return plain(imported.where(F.size("errors") == 0).drop("oid", "inleesdatum", "errors"))


@query
def survey_parse_header(spark, sf):
    return survey.header_entries(_lines(spark, sf))


@query
def survey_parse_body(spark, sf):
    return _typed(survey.parse_lines(_lines(spark, sf)))


@query
def survey_parse_semicolon(spark, sf):
    return _typed(survey.parse_lines(_lines(spark, sf, delimiter=";"), delimiter=";"))


@query
def survey_semicolon_round_trip(spark, sf):
    """Two large files, written as cleaned copies in several parts each and read again."""
    path = scratch_path(spark, "round-trip")
    rows = given.measurements(spark, sf).withColumns(
        {
            "meting_serie_naam": F.concat(F.lit("B"), (F.col("oid") % 2).cast("string"), F.lit(" M1")),
            "locatieomschrijving": F.lit("café aan de Schöne straße"),
        }
    )
    sinks.write_normalized(settle(given.survey_lines(rows), "survey-lines"), path, repair=True, parts=7)
    again = survey.parse_lines(normalized_lines(spark, path), delimiter=";")
    return _typed(again.withColumn("columns", F.concat_ws(";", "columns"))).drop("columns")


@query
def survey_parse_positional(spark, sf):
    return _typed(survey.parse_lines(_lines(spark, sf, "positional"), "positional"), "positional")


@query
def survey_mixed_layouts(spark, sf):
    """Keyed and positional files side by side, each read by its own rules."""
    m = given.measurements(spark, sf)
    odd = F.substring("meting_serie_naam", 8, 1).cast("int") % 2 == 1
    lines = given.survey_lines(m.where(odd), "positional").unionByName(given.survey_lines(m.where(~odd)))
    rows = survey.parse_lines(settle(lines, "survey-lines"), "mixed")
    return _typed(rows, "mixed")


def _survey_folder(spark, sf) -> str:
    path = scratch_path(spark, "survey-files")
    given.write_survey_files(given.measurements(spark, sf), path)
    return path


def _file_sums(rows):
    return rows.groupBy("meting_serie_naam").agg(
        F.count("*").alias("n"),
        F.sum("rl").alias("rl"),
        F.sum("kmp").cast("double").alias("kmp"),
        F.min("tijdstip_meting").alias("first_at"),
        F.max("tijdstip_meting").alias("last_at"),
    )


@query
def survey_read_files(spark, sf):
    rows = read_survey(spark, _survey_folder(spark, sf), pattern="*.txt")
    good = survey.accepted(survey.import_rows(rows, READ_AT))
    return _file_sums(good)


@query
def survey_read_large_files(spark, sf):
    rows = survey.parse_lines(file_lines(spark, _survey_folder(spark, sf), pattern="*.txt"))
    good = survey.accepted(survey.import_rows(rows, READ_AT))
    return _file_sums(good)


@query
def survey_read_all_columns(spark, sf):
    """Every column of every line of survey files, read whole, line by line and by the stream."""
    folder = _survey_folder(spark, sf)
    table, checkpoint = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    start_ingest(
        spark, folder, table, checkpoint, READ_AT, pattern="*.txt", files_per_batch=40, name=_file_of
    ).awaitTermination()
    ways = {
        "whole": survey.accepted(survey.import_rows(read_survey(spark, folder, pattern="*.txt"), READ_AT)),
        "lines": survey.accepted(survey.import_rows(survey.parse_lines(file_lines(spark, folder, pattern="*.txt")), READ_AT)),
        "stream": spark.read.parquet(table).drop("batch"),
    }
    rows = [df.drop("oid", "bestands_url", "inleesdatum").withColumn("way", F.lit(way)) for way, df in ways.items()]
    return plain(survey.union_frames(rows))


def _file_of(url):
    return F.regexp_extract(url, r"bestand=([^/]+)/", 1)


def _counted(files, imported):
    """Per file what became of it and of its lines."""
    bad = F.size("errors") > 0
    lines = imported.groupBy("bestands_url").agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
    none = F.lit(0).cast("long")
    return files.join(lines, "bestands_url", "left").select(
        _file_of("bestands_url").alias("file"),
        "outcome",
        "toestel",
        F.coalesce("good", none).alias("n_good"),
        F.coalesce("bad", none).alias("n_bad"),
    )


@query
def survey_file_outcomes(spark, sf):
    """Sound and broken files, read whole and line by line."""
    path = scratch_path(spark, "broken-files")
    given.write_survey_files(given.measurements(spark, sf), path, broken=True)
    found = []
    for way, size in (("whole", WHOLE_FILE_BYTES), ("lines", 0)):
        headers, rows = scan_survey(spark, path, pattern="*.txt", whole_file_bytes=size)
        found.append(_counted(headers, survey.import_rows(rows, READ_AT)).withColumn("way", F.lit(way)))
    return survey.union_frames(found)


def _segment_export(spark, sf, remark):
    s = given.segments(spark, sf)
    empty = F.lit("")
    exported = {
        "objectid": F.col("id"),
        "id": F.col("id"),
        "ident8": F.col("ident8"),
        "beginopschrift": F.col("beginpositie"),
        "beginafstand": empty,
        "beginpositie": F.col("beginpositie"),
        "eindopschrift": F.col("eindpositie"),
        "eindafstand": empty,
        "eindpositie": F.col("eindpositie"),
        "gebied": F.col("gebied"),
        "eigenbeheer": F.col("eigenbeheer"),
        "opmerking": remark,
        "lengte": F.col("eindpositie") - F.col("beginpositie"),
        "werkelijkelengte": empty,
        "gebruiker": F.lit("beheer"),
        "opnamedatum": F.lit("2024-01-02 03:04:05"),
        "begindatum": F.lit("2024-01-02"),
        "creatiedatum": empty,
        "wijzigingsdatum": empty,
        "deltawijzigingsdatum": empty,
        "bronid": F.col("id") % 9,
        "wegcategorie": F.col("wegcategorie"),
        "offset_": F.col("id") % 5 - 2,
        "copydatum": F.lit("2024-02-03 04:05:06"),
    }
    return s.select(*[c.cast("string").alias(n) for n, c in exported.items()])


def _written_segments(export, path):
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    export.write.options(sep="\t", header=True, escape="\\", emptyValue="", **kept).csv(path)
    return path


@query
def segment_load(spark, sf):
    remark = F.concat(F.lit('zie "plan"\t'), F.col("id").cast("string"))
    path = _written_segments(_segment_export(spark, sf, remark), scratch_path(spark, "segment-export"))
    ways = [read_segments(spark, path, quoted_breaks=m).withColumn("multi_line", F.lit(m)) for m in (False, True)]
    return plain(survey.union_frames(ways))


@query
def segment_load_quoted_breaks(spark, sf):
    """One large file whose remarks hold line breaks, quotes, tabs and backslashes."""
    number = F.col("id").cast("string")
    remark = (
        F.when(F.col("id") % 3 == 0, F.concat(F.lit('zie "plan"\n\t"deel" '), number, F.lit("\n")))
        .when(F.col("id") % 3 == 1, F.concat(F.lit('\n\n"'), number, F.lit('"\\')))
        .otherwise(number)
    )
    export = _segment_export(spark, sf, remark).repartitionByRange(1, "id")
    return plain(read_segments(spark, _written_segments(export, scratch_path(spark, "segment-export"))))


@query
def class_bands_values(spark, sf):
    rows = given.measurements(spark, sf).select("rl")
    matched = band_join(rows, given.classes(spark), "rl", "l_min", "l_max")
    return matched.groupBy("klasse", "l_min", "l_max").agg(F.count("*").alias("n"))


# --- sinks ------------------------------------------------------------------


@query
def sink_refresh(spark, sf):
    path = scratch_path(spark, "refresh")
    m = given.measurements(spark, sf).select("oid", "kmp", "rl")
    sinks.refresh(m, path, 2023)
    sinks.refresh(m, path, 2024)
    sinks.refresh(m.where(F.col("rl") != 0), path, 2024)
    return plain(sinks.read_table(spark, path))


@query
def sink_create_if_absent(spark, sf):
    path = scratch_path(spark, "create")
    m = given.measurements(spark, sf).select("oid", "kmp", "rl")
    sinks.create_if_absent(m, path)
    sinks.create_if_absent(m.where(F.col("rl") != 0), path)
    return plain(spark.read.parquet(path))


@query
def line_empty_schema(spark, sf):
    path = scratch_path(spark, "empty")
    lines = _measurement_lines(spark, sf).drop("geom_line")
    sinks.create_empty(lines, path)
    return plain(spark.read.parquet(path))


@query
def sink_append(spark, sf):
    path = scratch_path(spark, "append")
    m = given.measurements(spark, sf).drop("ident8")
    sinks.append(m.where(F.col("tijdstip_meting") < given.WATERMARK), path)
    sinks.append(m.where(F.col("tijdstip_meting") >= given.WATERMARK), path)
    return plain(spark.read.parquet(path))


@query
def survey_normalized_lines(spark, sf):
    path = scratch_path(spark, "normalized")
    sinks.write_normalized(_lines(spark, sf), path)
    return sinks.read_normalized(spark, path)


@query
def sink_combined_csv(spark, sf):
    path = scratch_path(spark, "combined")
    sinks.write_combined_csv(survey_combined_2024(spark, sf), path)
    return spark.read.option("sep", ";").option("header", True).csv(path)


@query
def sink_report_export(spark, sf):
    path = scratch_path(spark, "export")
    located = settle(_located(spark, sf), "located")
    counts = settle(shares.reading_counts(located), "reading-counts")
    tables = reports.all_reports(located, given.classes(spark), given.classes_p(spark), counts)
    places = sinks.export_reports(tables, path)

    def lines(name, place):
        """The text of a share report's rows; of the large reports their number."""
        read = spark.read.option("sep", ";").option("header", True).csv(place)
        if name in reports.SHARE_REPORTS:
            shown = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in sorted(read.columns)])
            return read.select(F.lit(name).alias("report"), shown.alias("line"))
        return read.agg(F.count("*").cast("string").alias("line")).select(F.lit(name).alias("report"), "line")

    return survey.union_frames([lines(name, place) for name, place in places.items()])


# --- file log ---------------------------------------------------------------


@query
def log_new_files(spark, sf):
    return ledger.new_files(given.listed_files(spark, sf), given.logged_files(spark, sf), READ_AT)


@query
def log_new_files_substring(spark, sf):
    path = F.concat_ws("/", "drive_folder_name", "drive_file_name")
    listed = given.listed_files(spark, sf).select("oid", path.alias("path"))
    logged = given.logged_files(spark, sf).select(
        F.concat(F.lit("archief/"), path, F.lit(".oud")).alias("bestands_url")
    )
    return ledger.new_paths(listed, logged)


@query
def incremental_watermark(spark, sf):
    m = given.measurements(spark, sf)
    target = m.where(F.col("inleesdatum") < given.WATERMARK)
    return plain(ledger.newer_rows(m, target).select("oid", "kmp", "rl", "inleesdatum"))


@query
def incremental_lines(spark, sf):
    """Lines of the second half of the month added to those of the first half, and ties of the last day before."""
    rows = _measurement_points(spark, sf)
    store = Store(spark, scratch_path(spark, "lines"))
    early = rows.where(F.col("inleesdatum") < given.WATERMARK)
    tied = early.agg(F.max("inleesdatum")).scalar()
    append_new_lines(store, early.where((F.col("inleesdatum") < tied) | (F.col("oid") % 3 == 0)), given.SURVEY_YEAR)
    append_new_lines(store, early, given.SURVEY_YEAR)
    append_new_lines(store, rows, given.SURVEY_YEAR)
    lines = append_new_lines(store, rows, given.SURVEY_YEAR)
    return plain(lines.drop("geom_line").withColumn("lengte", F.round("lengte", 3)))


@query
def work_queue(spark, sf):
    return ledger.work_queue(given.file_log(spark, sf), given.LOG_YEAR)


@query
def file_state_transition(spark, sf):
    """Every third file turns out to have another series name than the log had."""
    log = given.file_log(spark, sf)
    series = F.col("measure_series_name")
    read = F.when(F.col("oid") % 3 == 0, F.concat(series, F.lit(" nieuw"))).otherwise(series)
    queue = ledger.work_queue(log, given.LOG_YEAR).withColumn("measure_series_name", read)
    return ledger.apply_checks(log, ledger.check_names(queue))


@query
def ingest_log_build(spark, sf):
    return ledger.ingest_log(given.file_log(spark, sf), given.LOG_YEAR)


@query
def conform_files(spark, sf):
    return ledger.conform_files(ingest_log_build(spark, sf))


@query
def nonconform_files(spark, sf):
    return ledger.nonconform_files(ingest_log_build(spark, sf))


@query
def nonconform_count(spark, sf):
    return ledger.nonconform_count(ingest_log_build(spark, sf))


@query
def ingested_files(spark, sf):
    return ledger.ingested_files(ingest_log_build(spark, sf))


def _ingest_with_gaps(spark, sf):
    """The ingest log with the status of every fifth file unknown."""
    return ingest_log_build(spark, sf).withColumn(
        "ctr_header_bestandsnaam", F.when(F.col("oid") % 5 != 0, F.col("ctr_header_bestandsnaam"))
    )


@query
def purge_nonconform_log(spark, sf):
    return ledger.purge_nonconform_log(_ingest_with_gaps(spark, sf))


@query
def purge_nonconform_measurements(spark, sf):
    kept = ledger.purge_nonconform_measurements(given.measurements(spark, sf), _ingest_with_gaps(spark, sf))
    return plain(kept.select("oid", "bestands_url", "kmp", "rl"))


@query
def measurement_log_join(spark, sf):
    joined = ledger.measurements_with_status(given.measurements(spark, sf), ingest_log_build(spark, sf))
    return plain(joined.select("oid", "bestands_url", "kmp", "rl", "inleesdatum"))


@query
def backlog_count(spark, sf):
    return ledger.backlog_count(given.listed_files(spark, sf), ingest_log_build(spark, sf))


# --- filters and name checks ------------------------------------------------


@query
def filter_survey_year(spark, sf):
    return ledger.survey_year_files(given.file_log(spark, sf), given.LOG_YEAR)


@query
def filter_nonzero_rl(spark, sf):
    m = given.measurements(spark, sf)
    rows = m.withColumn("rl", F.when(F.col("oid") % 13 != 0, F.col("rl")))
    return rows.where(F.col("rl") != 0).select("oid", "rl")


@query
def filter_rl_text(spark, sf):
    e = given.measurements(spark, sf)
    shown = F.when(F.col("oid") % 5 == 1, F.concat(F.col("rl").cast("string"), F.lit(",0"))).when(
        F.col("oid") % 5 != 2, F.col("rl").cast("string")
    )
    return survey.nonzero_text(e.select("oid", shown.alias("RL")))


@query
def filter_road_category(spark, sf):
    s = given.segments(spark, sf)
    kind = F.col("wegcategorie")
    return s.where(kind.startswith("H") | kind.startswith("P")).select("id", "wegcategorie")


@query
def filter_marking_prefix(spark, sf):
    kind = F.col("markering")
    return given.measurements(spark, sf).where(kind.startswith("M1") | kind.startswith("M2")).select("oid", "markering")


@query
def name_conformity(spark, sf):
    checked = ledger.check_names(given.file_log(spark, sf))
    return checked.select("oid", "drive_file_name", "drive_folder_name", "measure_series_name", "name_conform")


@query
def name_conformity_2024(spark, sf):
    log = given.file_log(spark, sf)
    series = F.when(F.col("oid") % 11 != 0, F.col("measure_series_name"))  # every eleventh file has none
    reason = text.rejection_2024(F.col("drive_file_name"), F.col("drive_folder_name"), series)
    return log.select("oid", "drive_file_name", reason.alias("reason"))


@query
def name_conformity_status(spark, sf):
    log = given.file_log(spark, sf)
    series = F.when(F.col("oid") % 4 == 0, F.concat("measure_series_name", F.lit("\r\n"))).otherwise(
        F.col("measure_series_name")
    )
    status = text.conformity_status(text.file_stem(F.col("drive_file_name")), F.col("drive_folder_name"), series)
    return log.select("oid", status.alias("status"))


@query
def legacy_log_rows(spark, sf):
    root = f"H:\\metingen\\Meetjaar {given.LOG_YEAR}\\in"
    files = given.file_log(spark, sf).select(
        F.concat_ws("\\", F.lit(root), "drive_folder_name", "drive_file_name").alias("bestands_url"),
        F.concat("measure_series_name", F.lit("\n")).alias("meting_serie_naam"),
    )
    return ledger.legacy_log(files, root, f"Meetjaar {given.LOG_YEAR}", READ_AT)


# --- scalar expressions -----------------------------------------------------


@query
def scalar_left_right(spark, sf):
    area = F.col("gebied")
    short = F.left(area, (F.col("id") % 4).cast("int"))
    return given.segments(spark, sf).select(
        "id",
        text.left(area, 8).alias("left8"),
        text.left(area, 2).alias("left2"),
        text.right(area, 1).alias("right1"),
        text.right(area, 6).alias("right6"),
        text.third_from_end(area).alias("digit"),
        text.third_from_end(short).alias("digit_short"),
    )


@query
def series_name_slices(spark, sf):
    series = F.col("meting_serie_naam")
    road, kind = survey.series_parts(series)
    return given.measurements(spark, sf).select(
        "oid",
        road.alias("road"),
        kind.alias("kind"),
        text.first_token(series).alias("first_word"),
        text.file_stem(F.col("bestands_url")).alias("stem"),
        F.element_at(F.split("bestands_url", "/"), -1).alias("file_name"),
    )


@query
def coord_text(spark, sf):
    lat = F.when(F.col("oid") % 5 != 0, F.col("latitude_start"))
    lon = F.when(F.col("oid") % 7 != 0, F.col("longitude_start"))
    return given.measurements(spark, sf).select("oid", text.coord_text(lat, lon).alias("start_coord"))


@query
def clean_series_name(spark, sf):
    raw = F.concat("measure_series_name", F.when(F.col("oid") % 2 == 0, "\n").otherwise("\r\n"))
    return given.file_log(spark, sf).select(
        "oid",
        F.translate(raw, "\n", "").alias("no_newline"),
        text.drop_line_breaks(raw).alias("no_breaks"),
    )


@query
def clean_fields(spark, sf):
    d = given.read(spark, sf, "documents")
    return d.select("doc_id", F.md5(text.clean_field(F.col("text"))).alias("clean_md5"))


@query
def decimal_comma(spark, sf):
    shown = F.replace(F.col("value").cast("decimal(18,4)").cast("string"), F.lit("."), F.lit(","))
    typed = text.to_decimal(shown, 10, 2)
    rounded = text.to_int(shown)
    e = given.read(spark, sf, "events")
    return plain(e.select("event_id", typed.alias("typed"), rounded.alias("whole")))


def _day_first(sep):
    """The measuring time with the day first; a bad date in every seventeenth row."""
    ts = F.col("tijdstip_meting_tekst")
    day, month, year = F.substring(ts, 9, 2).cast("int"), F.substring(ts, 6, 2).cast("int"), F.substring(ts, 1, 4)
    good = F.concat(day, F.lit(sep), month, F.lit(sep), year, F.substring(ts, 11, 9))
    return F.when(F.col("oid") % 17 == 0, F.lit(f"99{sep}99{sep}2024 00:00:00")).otherwise(good)


@query
def parse_measure_time(spark, sf):
    shown = F.when(F.col("oid") % 3 == 0, F.col("tijdstip_meting_tekst")).otherwise(_day_first("/"))
    parsed = given.measurements(spark, sf).select("oid", times.measure_time(shown).alias("tijdstip_meting"))
    return parsed.withColumn("tekst", times.iso_text(F.col("tijdstip_meting")))


@query
def parse_measure_time_legacy(spark, sf):
    shown = F.when(F.col("oid") % 3 == 0, _day_first("-")).otherwise(_day_first("/"))
    m = given.measurements(spark, sf)
    return m.select("oid", times.measure_time_legacy(shown).alias("tijdstip_meting"))


@query
def map_offset(spark, sf):
    m = given.measurements(spark, sf)
    return m.select("oid", points.map_offset(F.col("markering"), F.col("ident8")).alias("kaart_offset"))


@query
def direction_offset(spark, sf):
    road = F.when(F.col("oid") % 9 == 0, F.lit("N0000000")).otherwise(F.col("ident8"))
    return given.measurements(spark, sf).select("oid", points.direction_offset(road).alias("offset_1000"))


@query
def photo_slots(spark, sf):
    i = F.col("event_id").cast("string")
    slots = []
    for n in range(6):
        named = F.concat(F.lit(f"a{n}_"), i, F.lit(f".jpgb{n}_"), i, F.lit(".jpg"))
        plain_name = F.concat(F.lit(f"p{n}_"), i)
        slots.append(
            F.when(F.col("event_id") % (n + 2) == 0, named)
            .when(F.col("event_id") % 11 == n, plain_name)
            .otherwise("-")
        )
    first, second = text.photo_names(F.array(*slots))
    e = given.read(spark, sf, "events")
    return e.select("event_id", first.alias("naam_foto1"), second.alias("naam_foto2"))


@query
def header_repair(spark, sf):
    """All lines; the speed column of column rows has its right name."""
    return survey.normalized_line(_lines(spark, sf), repair=True).select("bestands_url", "value")


# --- segments and classes ---------------------------------------------------


@query
def segment_enrich(spark, sf):
    return plain(segments.enrich(given.segments(spark, sf)))


def _located(spark, sf, ordered=False):
    m = given.measurements(spark, sf)
    return segments.on_segments(m, segments.enrich(given.segments(spark, sf)), ordered)


@query
def segment_interval_join(spark, sf):
    return plain(_located(spark, sf, ordered=True))


@query
def class_band_join(spark, sf):
    rows = given.measurements(spark, sf).select("oid", "rl")
    return band_join(rows, given.classes(spark), "rl", "l_min", "l_max", spread_by=["oid"])


@query
def class_band_join_p(spark, sf):
    rows = given.measurements(spark, sf).select("oid", "rl")
    return band_join(rows, given.classes_p(spark), "rl", "l_min", "l_max", spread_by=["oid"])


def _counted_classes(spark, sf):
    return shares.classify_counts(shares.reading_counts(_located(spark, sf)), given.classes(spark))


@query
def class_counts(spark, sf):
    return shares.class_counts(_counted_classes(spark, sf), ["jaar", "markering", "provincie"])


@query
def share_denominator(spark, sf):
    counts = shares.class_counts(_counted_classes(spark, sf), ["provincie"])
    return shares.with_total(counts, "provincie").select("provincie", "klasse", "n", "totaal")


@query
def class_share_province(spark, sf):
    return shares.class_share(_counted_classes(spark, sf), "provincie")


@query
def class_share_marking(spark, sf):
    return shares.class_share(_counted_classes(spark, sf), "provincie", "M1")


@query
def class_share_region(spark, sf):
    return shares.class_share(_counted_classes(spark, sf).withColumn("gebied", F.lit("Vlaanderen")), "gebied")


@query
def share_union_form(spark, sf):
    """One branch per province, united and made distinct."""
    counts = settle(shares.class_counts(_counted_classes(spark, sf), ["jaar", "provincie"]), "class-counts")
    branches = []
    for name in PROVINCES.values():
        branch = shares.with_total(counts.where(F.col("provincie") == name), "provincie")
        branches.append(branch.withColumn("percentage_metingen", shares.percentage(F.col("n"), F.col("totaal"))))
    united = survey.union_frames(branches).distinct()
    return united.select(*reports.share_columns(reports.SHARE_REPORTS["procent_per_prov_m"]))


# --- the 2024 path ----------------------------------------------------------


@query
def survey_tag_rows_2024(spark, sf):
    tagged = survey.tag_rows(survey.parse_lines(_lines(spark, sf)))
    return tagged.select(
        "bestands_url", "line_no", F.concat_ws(";", "names").alias("names"), F.concat_ws(";", "texts").alias("texts")
    )


@query
def survey_combined_2024(spark, sf):
    lines = _lines(spark, sf)
    # Every fifth road lies in a wrong folder.
    moved = F.regexp_replace("bestands_url", r"^survey/([^/]*[05])[12]/", "survey/elders/")
    lines = lines.withColumn("bestands_url", moved)
    headers = survey.line_headers(lines)
    return survey.combined_2024(survey.parse_lines(lines, headers=headers), headers).drop("bestands_url")


@query
def survey_union_years(spark, sf):
    m = given.measurements(spark, sf)
    early = m.where(F.col("tijdstip_meting") < given.WATERMARK).select("oid", "kmp", "rl")
    late = m.where(F.col("tijdstip_meting") >= given.WATERMARK).select("oid", "rl", "marker")
    return plain(survey.union_frames([early, late]))


# --- geometry ---------------------------------------------------------------


@query
def point_wgs84(spark, sf):
    geom = geo.point(F.col("longitude_start"), F.col("latitude_start"))
    return given.measurements(spark, sf).select("oid", geom.alias("geom")).select("oid", "geom.x", "geom.y")


def _planar(spark, sf):
    return geo.with_lambert72(given.measurements(spark, sf), "longitude_start", "latitude_start", "x", "y")


@query
def projection_round_trip(spark, sf):
    """The places of the measurements, back from the plane by other formulas: how many, how many off by a millimetre."""
    there = _planar(spark, sf).withColumns({c: F.col(f"{c}_start").cast("double") for c in ("longitude", "latitude")})
    back = geo.with_wgs84(there, "x", "y", "lon", "lat")
    off = geo.ground_distance(F.col("lon"), F.col("lat"), F.col("longitude"), F.col("latitude"))
    return back.agg(F.count("*").alias("n"), F.count_if(off >= 0.001).alias("n_off"))


@query
def point_lambert72(spark, sf):
    return _planar(spark, sf).select("oid", centimetres("x").alias("x"), centimetres("y").alias("y"))


@query
def point_coords_int(spark, sf):
    return _planar(spark, sf).select(
        "oid", geo.whole_metre(F.col("x")).alias("x_coord"), geo.whole_metre(F.col("y")).alias("y_coord")
    )


def _measurement_points(spark, sf):
    rows = given.measurements(spark, sf).withColumn("line_no", F.col("oid") + 100)
    return points.measurement_points(rows, given.SURVEY_YEAR)


def _measurement_lines(spark, sf):
    return points.measurement_lines(_measurement_points(spark, sf))


@query
def line_geometry(spark, sf):
    lines = points.with_line(_measurement_points(spark, sf))
    return lines.select(
        "oid",
        centimetres("geom_line.p0.x").alias("end_x"),
        centimetres("geom_line.p0.y").alias("end_y"),
        centimetres("geom_line.p1.x").alias("start_x"),
        centimetres("geom_line.p1.y").alias("start_y"),
    )


@query
def line_length(spark, sf):
    lines = points.with_line(_measurement_points(spark, sf))
    return lines.select("oid", F.round(geo.line_length(F.col("geom_line")), 3).alias("lengte"))


@query
def line_length_filter(spark, sf):
    return _measurement_lines(spark, sf).select("oid")


@query
def line_srid_check(spark, sf):
    lines = _measurement_lines(spark, sf)
    srid = F.when(F.col("oid") % 100 != 0, F.lit(LAMBERT72_SRID))
    return points.srid_check(lines.withColumn("srid", srid))


@query
def report_points(spark, sf):
    rows = _measurement_points(spark, sf)
    geom = {"geom_x": centimetres("geoml72.x"), "geom_y": centimetres("geoml72.y")}
    return plain(rows.withColumns(geom).drop("geoml72"))


@query
def report_lines(spark, sf):
    rows = _measurement_lines(spark, sf)
    return plain(rows.drop("geom_line").withColumn("lengte", F.round("lengte", 3)))


# --- report tables ----------------------------------------------------------


@query
def report_per_district_wegcat(spark, sf):
    located = reports.located(_measurement_points(spark, sf), segments.enrich(given.segments(spark, sf)))
    geom = {"geom_x": centimetres("geoml72.x"), "geom_y": centimetres("geoml72.y")}
    return plain(located.withColumns(geom).drop("geoml72"))


def _class_report(name, spark, sf):
    return plain(reports.class_report(_located(spark, sf), given.classes(spark), given.classes_p(spark), name))


def _share_report(report, spark, sf):
    counts = shares.reading_counts(_located(spark, sf))
    return reports.share_report(counts, given.classes(spark), given.classes_p(spark), report, ordered=True)


def _export_read(name, spark, sf):
    """One of the large reports, exported and read again with the report's types."""
    located = reports.located(_measurement_points(spark, sf), segments.enrich(given.segments(spark, sf)))
    tables = {reports.LOCATED: located, name: located}
    if name != reports.LOCATED:
        tables[name] = reports.class_report(located, given.classes(spark), given.classes_p(spark), name)
    report = tables[name]
    place = sinks.export_reports({name: report}, scratch_path(spark, "export"))[name]
    texts = spark.read.option("sep", ";").option("header", True).csv(place)
    assert texts.columns == report.columns
    typed = [
        F.from_json(F.col(f.name), f.dataType.simpleString()).alias(f.name)
        if f.dataType.typeName() == "struct"
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in report.schema
    ]
    read = texts.select(*typed)
    if "geoml72" in read.columns:
        read = read.withColumns({"geom_x": centimetres("geoml72.x"), "geom_y": centimetres("geoml72.y")}).drop("geoml72")
    return plain(read)


for _name in (reports.LOCATED, *reports.CLASS_REPORTS):
    QUERIES[f"export_{_name.lower()}"] = partial(_export_read, _name)


@query
def reading_counts_by_file(spark, sf):
    """Counts of the roads loaded at last: some came first, some of these went, the others came later."""
    rows = given.measurements(spark, sf)
    store, s = Store(spark, scratch_path(spark, "located")), segments.enrich(given.segments(spark, sf))
    rows = settle(rows.withColumn("bestands_url", F.col("ident8")), "by-file")
    road = F.substring("ident8", 2, 6).cast("int") % 10
    counts = None
    for loaded in (road < 6, road < 4, road.between(0, 3) | (road > 5)):
        located, counts = update_located(store, rows.where(loaded), s, given.SURVEY_YEAR)
    total = located.where("rl <> 0").agg(F.count("*").alias("n"))
    none = [F.lit(None).cast(t).alias(n) for n, t in counts.dtypes if n != "n"]
    return counts.unionByName(total.select(*none, "n"))


for _name in reports.CLASS_REPORTS:
    QUERIES[f"report_{_name.lower()}"] = partial(_class_report, _name)
for _name, _report in reports.SHARE_REPORTS.items():
    QUERIES[f"report_{_name.lower()}"] = partial(_share_report, _report)


# --- streaming --------------------------------------------------------------


@query
def stream_ingest(spark, sf):
    """Load the survey files in small batches, twice; the second run finds nothing new."""
    folder = _survey_folder(spark, sf)
    table, checkpoint = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    for _ in range(2):
        start_ingest(
            spark, folder, table, checkpoint, READ_AT, pattern="*.txt", files_per_batch=40, name=_file_of
        ).awaitTermination()
    return _file_sums(spark.read.parquet(table))


@query
def stream_ingest_outcomes(spark, sf):
    """Sound and broken files in small batches: no file and no line is lost."""
    path = scratch_path(spark, "broken-files")
    given.write_survey_files(given.measurements(spark, sf), path, broken=True)
    table, checkpoint = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    start_ingest(
        spark, path, table, checkpoint, READ_AT, pattern="*.txt", files_per_batch=40, name=_file_of
    ).awaitTermination()
    sound = spark.read.parquet(table).select("bestands_url", F.array().cast("array<string>").alias("errors"))
    faulty = spark.read.parquet(f"{table}_rejected").select("bestands_url", "errors")
    return _counted(spark.read.parquet(f"{table}_files"), sound.unionByName(faulty))


@query
def stream_first_name(spark, sf):
    """Files of two runs, of which five share a name each: the first path of the first run has it."""
    rows = given.measurements(spark, sf)
    folder, table = scratch_path(spark, "survey-files"), scratch_path(spark, "stream-table")
    checkpoint = scratch_path(spark, "stream-checkpoint")

    def number(path):
        return F.regexp_extract(path, "bestand=B0*([0-9]+)", 1).cast("long")

    for late in (True, False):
        # Files that sort first come in the second run.
        given.write_survey_files(rows.where((F.col("oid").cast("long") < 3000) != late), f"{folder}/{int(late)}")
        start_ingest(
            spark, folder, table, checkpoint, READ_AT, pattern="*.txt", files_per_batch=3,
            name=lambda path: (number(path) % 5).cast("string"),
        ).awaitTermination()
    files = spark.read.parquet(f"{table}_files")
    lines = spark.read.parquet(table).groupBy("bestands_url").agg(F.count("*").alias("n"))
    return files.join(lines, "bestands_url", "left").select(
        number("bestands_url").alias("file"), "outcome", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


# --- order and years --------------------------------------------------------


def _placed(df, *order):
    """The columns of the order with the place of each row in it."""
    return numbered(df.select(*order), list(order)).withColumn("place", F.col("place").cast("int"))


@query
def order_ingested_files(spark, sf):
    return _placed(ledger.ingested_files(ingest_log_build(spark, sf)), "bestands_url")


@query
def order_segment_join(spark, sf):
    located = segments.on_segments(given.measurements(spark, sf), segments.enrich(given.segments(spark, sf)))
    return plain(_placed(located, "ident8", "kmp", "oid"))


@query
def order_share_report(spark, sf):
    report = _share_report(reports.SHARE_REPORTS["procent_per_prov_M1"], spark, sf)
    return _placed(report, "provincie", "markering", "klasse")


@query
def points_of_one_year(spark, sf):
    """Every fourth measurement is moved to the next year and stays out."""
    moved = F.expr("tijdstip_meting + INTERVAL 1 YEAR")
    rows = given.measurements(spark, sf).withColumn(
        "tijdstip_meting", F.when(F.col("oid") % 4 == 0, moved).otherwise(F.col("tijdstip_meting"))
    )
    return points.measurement_points(rows, given.SURVEY_YEAR).select("oid", "tijdstip_meting")
