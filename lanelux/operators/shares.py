"""Quality classes of measurements and their shares of a total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanelux.operators.joins import ROWS_PER_TASK, band_join
from lanelux.operators.points import direction_offset
from lanelux.schemas import CLASS_COLUMNS

# Column order of the stored table.
CLASSIFIED_COLUMNS = [
    "ident8", "kmp", "tijdstip_meting", "meting_serie_naam", "markering", "locatieomschrijving", "rl",
    "rlmin", "rlmax", "rlstddev", "rlprocpass", "snelheid", "latitude_start", "longitude_start",
    "latitude_eind", "longitude_eind", "district", "provincie", "wegcategorie", *CLASS_COLUMNS,
    "offset_1000",
]


def classify(
    wegcat: DataFrame,
    classes: DataFrame,
    category: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Nonzero readings with each quality class that holds them.

    ``category`` keeps one kind of road by the first letter of its category.
    """
    rows = wegcat.where(F.col("rl") != 0)
    if category:
        rows = rows.where(F.col("wegcategorie").startswith(category))
    matched = band_join(rows, classes, "rl", "l_min", "l_max", spread_by=["oid"], rows_per_task=rows_per_task)
    return matched.withColumn("offset_1000", direction_offset(F.col("ident8"))).select(*CLASSIFIED_COLUMNS)


def reading_counts(wegcat: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Number of nonzero readings per year, marking, province, road letter and reading, and per ``by``.

    All share reports start from this table. It is bounded by the values that
    occur, not by the number of measurements, and partial counts are merged
    before the only shuffle.
    """
    return (
        wegcat.where(F.col("rl") != 0)
        .groupBy(
            *by,
            F.year("tijdstip_meting").alias("jaar"),
            "markering",
            "provincie",
            F.left("wegcategorie", F.lit(1)).alias("weg"),
            "rl",
        )
        .agg(F.count("*").alias("n"))
    )


def merged_counts(counts: DataFrame) -> DataFrame:
    """Reading counts from parts of them, of which withdrawn ones are negative; what comes to nothing is left out."""
    keys = ["jaar", "markering", "provincie", "weg", "rl"]
    return counts.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def classify_counts(counts: DataFrame, classes: DataFrame, category: str | None = None) -> DataFrame:
    """:func:`classify` on counted readings; column ``n`` holds the number."""
    rows = counts.where(F.col("weg") == category) if category else counts
    return band_join(rows, classes, "rl", "l_min", "l_max").drop("rl", "weg", "l_min", "l_max")


def class_counts(classified: DataFrame, keys: list[str]) -> DataFrame:
    """Number of readings per ``keys`` and class, of rows that carry a count ``n``."""
    return classified.groupBy(*keys, *CLASS_COLUMNS).agg(F.sum("n").alias("n"))


def percentage(part: Column, total: Column) -> Column:
    """``part`` as percentage of ``total``, rounded half up to one decimal, exactly."""
    return F.call_function("div", part * 2000 + total, total * 2) / F.lit(10.0)


def with_total(counts: DataFrame, area: str) -> DataFrame:
    """Add the total of the area over all years and markings.

    Runs on counted rows, a few per area, so a region-wide total in one task
    is small.
    """
    return counts.withColumn("totaal", F.sum("n").over(Window.partitionBy(area)))


def class_share(
    classified: DataFrame,
    area: str,
    marking: str | None = None,
) -> DataFrame:
    """Share of each class in the readings of its area.

    Groups by year, class and area, and by marking if a marking prefix is
    given; the total spans all years and all markings with the prefix. Areas
    without a name are left out.
    """
    rows = classified.where(F.col(area).isNotNull())
    keys = ["jaar", area]
    if marking:
        rows = rows.where(F.col("markering").startswith(marking))
        keys.append("markering")
    shares = with_total(class_counts(rows, keys), area)
    return shares.withColumn("percentage_metingen", percentage(F.col("n"), F.col("totaal")))
