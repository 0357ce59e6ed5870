"""Column expressions on text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def left(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def right(text: Column, n: int) -> Column:
    return F.right(text, F.lit(n))


def third_from_end(text: Column) -> Column:
    """The third character from the end; the first one of a shorter text."""
    return left(right(text, 3), 1)


def first_token(text: Column) -> Column:
    return F.substring_index(text, " ", 1)


def clean_field(text: Column) -> Column:
    """Drop double quotes and semicolons."""
    return F.translate(text, '";', "")


def drop_line_breaks(text: Column) -> Column:
    return F.translate(text, "\r\n", "")


def coord_text(lat: Column, lon: Column) -> Column:
    """``lat,lon`` where a missing part becomes empty and the comma stays."""

    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit(""))

    return F.concat(shown(lat), F.lit(","), shown(lon))


def decimal_comma(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("."))


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Text with a decimal comma or point; unreadable text gives NULL."""
    return F.trim(decimal_comma(text)).try_cast(f"decimal({precision},{scale})")


def to_int(text: Column) -> Column:
    """Whole number; a fraction rounds half away from zero."""
    return F.coalesce(F.trim(text).try_cast("int"), F.round(to_decimal(text, 38, 18)).try_cast("int"))


def file_stem(name: Column) -> Column:
    """The name without its four-character extension."""
    return F.left(name, F.greatest(F.length(name) - 4, F.lit(0)))


def stem_matches(file_name: Column, series: Column) -> Column:
    return file_stem(file_name) == series


def folder_matches(folder: Column, series: Column) -> Column:
    return first_token(series) == folder


def name_conform(file_name: Column, folder: Column, series: Column) -> Column:
    return stem_matches(file_name, series) & folder_matches(folder, series)


def rejection_2024(file_name: Column, folder: Column, series: Column) -> Column:
    """Why a file is left out of the combined table; NULL when it is taken.

    A file without series name is never taken.
    """
    return F.when(~first_token(file_name).eqNullSafe(folder), F.lit("map")).when(
        ~F.regexp_replace(file_name, r"\.[^.]*$", "").eqNullSafe(series), F.lit("reeks")
    )


def conformity_status(stem: Column, folder: Column, series: Column) -> Column:
    """The two name checks as one status text."""
    clean = drop_line_breaks(series)
    # The status texts, spaces and exclamation mark included.
    name_part = F.when(stem == clean, F.lit("bestandsnaam conform header")).otherwise(
        F.lit(" bestandsnaam NIET conform header")
    )
    folder_part = F.when(folder_matches(folder, clean), F.lit(" / bestandsmap conform header")).otherwise(
        F.lit(" / bestandsmap NIET conform header!")
    )
    return F.concat(name_part, folder_part)


def photo_names(slots: Column) -> list[Column]:
    """The first two used photo slots, each as the second picture it names."""
    used = F.filter(slots, lambda s: s != "-")

    def name(i: int) -> Column:
        second = F.get(F.split(F.get(used, F.lit(i)), r"\.jpg"), F.lit(1))
        return F.coalesce(F.concat(second, F.lit(".jpg")), F.lit("-"))

    return [name(0), name(1)]
