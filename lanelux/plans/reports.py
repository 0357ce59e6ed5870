"""The report tables of a survey year."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanelux.operators.segments import on_segments
from lanelux.operators.shares import class_share, classify, classify_counts, reading_counts
from lanelux.schemas import ALL_MARKINGS, CLASS_COLUMNS, PROVINCES, REGION


@dataclass(frozen=True)
class ShareReport:
    """A share report: which roads, per province or region-wide, which markings."""

    category: str | None
    area: str
    marking: str | None


# Report names and what each one counts.
SHARE_REPORTS = {
    "procent_per_prov_m": ShareReport(None, "provincie", None),
    "procent_per_prov_vl_H": ShareReport("H", "gebied", None),
    "procent_per_prov_vl_H_m1": ShareReport("H", "gebied", "M1"),
    "procent_per_prov_vl_H_m2": ShareReport("H", "gebied", "M2"),
    "procent_per_prov_vl_P": ShareReport("P", "gebied", None),
    "procent_per_prov_vl_P_m1": ShareReport("P", "gebied", "M1"),
    "procent_per_prov_vl_P_m2": ShareReport("P", "gebied", "M2"),
    "procent_per_prov_M1": ShareReport(None, "provincie", "M1"),
    "procent_per_prov_M2": ShareReport(None, "provincie", "M2"),
    "procent_per_prov_hoofdweg": ShareReport("H", "provincie", None),
    "procent_per_prov_hoofdweg_M1": ShareReport("H", "provincie", "M1"),
    "procent_per_prov_hoofdweg_M2": ShareReport("H", "provincie", "M2"),
    "procent_per_prov_P1P2weg": ShareReport("P", "provincie", None),
    "procent_per_prov_P1P2weg_M1": ShareReport("P", "provincie", "M1"),
    "procent_per_prov_P1P2weg_M2": ShareReport("P", "provincie", "M2"),
}
CLASS_REPORTS = {
    "per_district_per_klasse": None,
    "per_district_per_klasse_H": "H",
    "per_district_per_klasse_P": "P",
}
LOCATED = "per_district_wegcat"
REPORTS = [LOCATED, *CLASS_REPORTS, *SHARE_REPORTS]


def class_table(category: str | None, classes: DataFrame, classes_p: DataFrame) -> DataFrame:
    """Primary roads have a class table of their own."""
    return classes_p if category == "P" else classes


def share_columns(report: ShareReport) -> list[str]:
    marked = ["markering"] if report.marking or report.area == "gebied" else []
    return ["jaar", "percentage_metingen", *marked, report.area, *CLASS_COLUMNS]


def share_report(
    counts: DataFrame,
    classes: DataFrame,
    classes_p: DataFrame,
    report: ShareReport,
    ordered: bool = False,
) -> DataFrame:
    """One share report from the reading counts."""
    classified = classify_counts(counts, class_table(report.category, classes, classes_p), report.category)
    if report.area == "gebied":
        classified = classified.withColumn("gebied", F.lit(REGION))
    else:
        classified = classified.where(F.col("provincie").isin(list(PROVINCES.values())))
    shares = class_share(classified, report.area, report.marking)
    if report.area == "gebied" and not report.marking:
        shares = shares.withColumn("markering", F.lit(ALL_MARKINGS))
    shares = shares.select(*share_columns(report))
    if ordered:
        shares = shares.orderBy(*[c for c in (report.area, "markering", "klasse") if c in shares.columns])
    return shares


def located(points: DataFrame, segments: DataFrame, ordered: bool = False) -> DataFrame:
    return on_segments(points, segments, ordered)


def class_report(wegcat: DataFrame, classes: DataFrame, classes_p: DataFrame, name: str) -> DataFrame:
    category = CLASS_REPORTS[name]
    return classify(wegcat, class_table(category, classes, classes_p), category)


def all_reports(
    wegcat: DataFrame, classes: DataFrame, classes_p: DataFrame, counts: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every report by name.

    ``wegcat`` should be a stored table. ``counts`` are its reading counts, if
    they are stored too; then the fifteen share reports do not read ``wegcat``.
    """
    counts = reading_counts(wegcat) if counts is None else counts
    reports = {LOCATED: wegcat}
    for name in CLASS_REPORTS:
        reports[name] = class_report(wegcat, classes, classes_p, name)
    for name, report in SHARE_REPORTS.items():
        reports[name] = share_report(counts, classes, classes_p, report)
    return reports
