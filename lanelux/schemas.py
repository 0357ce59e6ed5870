"""Schemas and fixed values of the survey data model."""

import re

from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(6,2)": T.DecimalType(6, 2),
    "decimal(10,4)": T.DecimalType(10, 4),
    "decimal(12,9)": T.DecimalType(12, 9),
    "decimal(38,8)": T.DecimalType(38, 8),
}


def _fields(columns: str) -> T.StructType:
    """A schema from ``name type`` pairs, without needing a session."""
    pairs = [pair.split() for pair in re.split(r",\s+", columns)]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names and types of the stored tables.
FILE_LOG = _fields(
    """
    oid bigint, drive_file_name string, drive_file_id string, drive_folder_name string,
    drive_folder_id string, measure_series_name string, datetime_utc_read timestamp_ntz,
    name_conform boolean, completed_step int, report_year int
    """
)

INGEST_LOG = _fields(
    """
    oid bigint, bestands_url string, map_bestand string, bestandsnaam string,
    measure_series_name string, ctr_header_bestandsnaam string, inleesdatum timestamp_ntz
    """
)

MEASUREMENT_RAW = _fields(
    """
    oid bigint, bestands_url string, toestel string, meting_serie_naam string, rijstrook string,
    toestel_zijde string, markering string, locatieomschrijving string, operator_naam string,
    kmp decimal(10,4), tijdstip_meting_tekst string, tijdstip_meting timestamp_ntz, rl int,
    rlmin int, rlmax int, rlstddev int, rlprocpass int, marker string, temperatuur int,
    vochtigheid int, snelheid decimal(6,2), reference string, longitude_start decimal(12,9),
    latitude_start decimal(12,9), longitude_eind decimal(12,9), latitude_eind decimal(12,9),
    naam_foto1 string, naam_foto2 string, inleesdatum timestamp_ntz
    """
)

SEGMENT = _fields(
    """
    objectid bigint, id int, ident8 string, beginopschrift decimal(38,8),
    beginafstand decimal(38,8), beginpositie decimal(38,8), eindopschrift decimal(38,8),
    eindafstand decimal(38,8), eindpositie decimal(38,8), gebied string, eigenbeheer string,
    opmerking string, lengte decimal(38,8), werkelijkelengte decimal(38,8), gebruiker string,
    opnamedatum timestamp_ntz, begindatum timestamp_ntz, creatiedatum timestamp_ntz,
    wijzigingsdatum timestamp_ntz, deltawijzigingsdatum decimal(38,8), bronid int,
    wegcategorie string, offset_ int, copydatum timestamp_ntz
    """
)

QUALITY_CLASS = _fields(
    """
    klasse string, luminatie string, performatieklasse string, beoordeling string,
    actie string, l_min int, l_max int
    """
)

# Longest text each stored column may hold.
TEXT_LIMITS = {
    "toestel": 100,
    "meting_serie_naam": 100,
    "rijstrook": 5,
    "toestel_zijde": 5,
    "markering": 5,
    "locatieomschrijving": 100,
    "operator_naam": 25,
    "tijdstip_meting_tekst": 25,
    "marker": 100,
    "reference": 25,
    "naam_foto1": 25,
    "naam_foto2": 25,
}

# Header keys of a survey file and the columns they fill.
HEADER_KEYS = {
    "Info:": "toestel",
    "Measure Series Name:": "meting_serie_naam",
    "Lane:": "rijstrook",
    "Side:": "toestel_zijde",
    "Marking Name:": "markering",
    "Remarks:": "locatieomschrijving",
    "Driver Name:": "operator_naam",
}

# Header line numbers of the positional layout.
POSITIONAL_HEADER = {
    0: "toestel",
    2: "meting_serie_naam",
    6: "rijstrook",
    9: "toestel_zijde",
    10: "markering",
    11: "locatieomschrijving",
    12: "operator_naam",
}
POSITIONAL_COLUMN_LINE = 18

# Province by area digit.
PROVINCES = {
    "1": "Antwerpen",
    "2": "Vlaams-Brabant",
    "3": "West-Vlaanderen",
    "4": "Oost-Vlaanderen",
    "7": "Limburg",
}

# Columns that describe a quality class.
CLASS_COLUMNS = ["klasse", "luminatie", "performatieklasse", "beoordeling", "actie"]

# Labels of the region-wide reports and of the name checks.
REGION = "Vlaanderen"
ALL_MARKINGS = "M1_M2"
CONFORM = "bestandsnaam conform header / bestandsmap conform header"
NOT_CONFORM = "bestandsnaam NIET conform header / bestandsmap NIET conform header"

# File states.
REGISTERED = 3
VALIDATED = 4

LAMBERT72_SRID = 31370
