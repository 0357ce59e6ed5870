"""The SQL that each query must equal, for DuckDB over the given tables."""

from __future__ import annotations

import math

from lanelux.functions import geo
from lanelux.operators.points import LINE_COLUMNS, POINT_COLUMNS
from lanelux.operators.segments import WEGCAT_COLUMNS
from lanelux.operators.shares import CLASSIFIED_COLUMNS
from lanelux.plans.adapters import BODY_COLUMNS, LOG_YEAR, SURVEY_YEAR, WATERMARK
from lanelux.plans.reports import CLASS_REPORTS, SHARE_REPORTS, share_columns
from lanelux.schemas import CLASS_COLUMNS, HEADER_KEYS, MEASUREMENT_RAW

ORACLE: dict[str, str] = {}

DECIMALS = {
    "kmp", "snelheid", "longitude_start", "latitude_start", "longitude_eind", "latitude_eind",
    "beginpositie", "eindpositie",
}


def cols(names, prefix="") -> str:
    return ", ".join(f"CAST({prefix}{n} AS DOUBLE) AS {n}" if n in DECIMALS else f"{prefix}{n}" for n in names)


def with_views(*views: str, body: str) -> str:
    """``body`` after the named views and the views these need."""
    needed: list[str] = []

    def need(name: str) -> None:
        for other in VIEWS[name][0]:
            need(other)
        if name not in needed:
            needed.append(name)

    for view in views:
        need(view)
    parts = ",\n".join(f"{v} AS ({VIEWS[v][1]})" for v in needed)
    return f"WITH {parts}\n{body}"


def road(number: str) -> str:
    return f"('N' || lpad(CAST({number} AS VARCHAR), 6, '0') || CASE WHEN {number} % 2 = 0 THEN '1' ELSE '2' END)"


MEASUREMENT = f"""
SELECT event_id AS oid,
  'temp/N' || lpad(CAST(user_id AS VARCHAR), 6, '0') || ' M1.xls' AS bestands_url,
  'toestel ' || (user_id % 4) AS toestel,
  {road("user_id")} || ' ' || markering AS meting_serie_naam,
  'R' || (user_id % 3 + 1) AS rijstrook,
  CASE WHEN user_id % 2 = 0 THEN 'L' ELSE 'R' END AS toestel_zijde,
  markering,
  'traject ' || (user_id % 50) AS locatieomschrijving,
  'operator ' || (user_id % 7) AS operator_naam,
  CAST((event_id * 37 % 1000) * 0.1 AS DECIMAL(10,4)) AS kmp,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS tijdstip_meting_tekst,
  ts AS tijdstip_meting,
  rl,
  CAST(rl - rl // 5 AS INTEGER) AS rlmin,
  CAST(rl + event_id % 40 AS INTEGER) AS rlmax,
  CAST(event_id % 17 AS INTEGER) AS rlstddev,
  CAST(event_id % 101 AS INTEGER) AS rlprocpass,
  CASE WHEN event_id % 50 = 0 THEN 'Obstakel' ELSE '-' END AS marker,
  CAST(event_id % 35 - 5 AS INTEGER) AS temperatuur,
  CAST(40 + event_id % 55 AS INTEGER) AS vochtigheid,
  CAST((event_id * 13 % 9000) * 0.01 AS DECIMAL(6,2)) AS snelheid,
  'ref ' || (event_id % 10) AS reference,
  CAST(2.6 + (event_id * 7919 % 3000) * 0.001 AS DECIMAL(12,9)) AS longitude_start,
  CAST(50.7 + (event_id * 31 % 700) * 0.001 AS DECIMAL(12,9)) AS latitude_start,
  CAST(2.6 + (event_id * 7919 % 3000) * 0.001 + (event_id % 20) * 0.0001 AS DECIMAL(12,9)) AS longitude_eind,
  CAST(50.7 + (event_id * 31 % 700) * 0.001 AS DECIMAL(12,9)) AS latitude_eind,
  CASE WHEN event_id % 4 = 0 THEN 'b' || event_id || '.jpg' ELSE '-' END AS naam_foto1,
  CASE WHEN event_id % 8 = 0 THEN 'd' || event_id || '.jpg' ELSE '-' END AS naam_foto2,
  CAST(CAST(ts AS DATE) AS TIMESTAMP) AS inleesdatum,
  {road("user_id")} AS ident8
FROM (SELECT *, CAST(floor(value) AS INTEGER) AS rl,
  CASE event_type WHEN 'view' THEN 'M1' WHEN 'click' THEN 'M2' WHEN 'purchase' THEN 'M1R'
    WHEN 'signup' THEN 'M2R' WHEN 'error' THEN 'M3' END AS markering FROM events)
"""

SEGMENT = f"""
SELECT CAST(p_partkey AS INTEGER) AS id, {road("(p_partkey // 10)")} AS ident8,
  CAST((p_partkey % 10) * 10 AS DECIMAL(38,8)) AS beginpositie,
  CAST((p_partkey % 10) * 10 + 10 AS DECIMAL(38,8)) AS eindpositie,
  'Regio D' || CASE p_partkey % 6 WHEN 0 THEN '111' WHEN 1 THEN '122' WHEN 2 THEN '113' WHEN 3 THEN '124'
    WHEN 4 THEN '117' ELSE '195' END || lpad(CAST(p_size AS VARCHAR), 2, '0') AS gebied,
  CASE WHEN p_partkey % 7 = 0 THEN 'false' ELSE 'true' END AS eigenbeheer,
  CASE p_partkey % 4 WHEN 0 THEN 'H' WHEN 1 THEN 'P1' WHEN 2 THEN 'P2' ELSE 'S' END AS wegcategorie
FROM part
"""

ENRICHED = """
SELECT *,
  CASE WHEN eigenbeheer = 'true' THEN right(gebied, 6) END AS district,
  CASE WHEN eigenbeheer = 'true' THEN CASE left(right(gebied, 3), 1)
    WHEN '1' THEN 'Antwerpen' WHEN '2' THEN 'Vlaams-Brabant' WHEN '3' THEN 'West-Vlaanderen'
    WHEN '4' THEN 'Oost-Vlaanderen' WHEN '7' THEN 'Limburg' END END AS provincie
FROM segment
"""

_CLASS_TEXT = """(VALUES ('A','laag','R1','slecht','vervangen'), ('B','matig','R2','matig','opvolgen'),
  ('C','goed','R3','goed','geen'), ('D','hoog','R4','zeer goed','geen'))
  t(klasse, luminatie, performatieklasse, beoordeling, actie)"""


def _class_view(limits: str) -> str:
    return f"""
SELECT t.*, CAST(l_min AS INTEGER) AS l_min, CAST(l_max AS INTEGER) AS l_max
FROM {_CLASS_TEXT} JOIN (VALUES {limits}) b(k, l_min, l_max) ON b.k = t.klasse
"""


FILE_LOG = """
SELECT o_orderkey AS oid, stem || '.xls' AS drive_file_name, 'id' || o_orderkey AS drive_file_id,
  'N' || lpad(CAST(folder AS VARCHAR), 6, '0') AS drive_folder_name, 'map' || folder AS drive_folder_id,
  CASE WHEN o_orderkey % 7 = 3 THEN stem || ' bis' ELSE stem END AS measure_series_name,
  o_orderdate AS datetime_utc_read,
  CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS name_conform,
  CAST(CASE WHEN o_orderstatus = 'P' THEN 3 ELSE 4 END AS INTEGER) AS completed_step,
  CAST(year(o_orderdate) AS INTEGER) AS report_year
FROM (SELECT *, 'N' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || ' M1' AS stem,
  o_custkey + CASE WHEN o_orderkey % 10 = 1 THEN 1 ELSE 0 END AS folder FROM orders)
"""

INGEST = f"""
SELECT oid, 'temp/' || drive_file_name AS bestands_url,
  '\\' || drive_folder_name || '\\' || drive_file_name AS map_bestand,
  drive_folder_name || '\\' || measure_series_name AS bestandsnaam, measure_series_name,
  CASE WHEN coalesce(name_conform, false) THEN 'bestandsnaam conform header / bestandsmap conform header'
    ELSE 'bestandsnaam NIET conform header / bestandsmap NIET conform header' END AS ctr_header_bestandsnaam,
  datetime_utc_read AS inleesdatum
FROM file_log WHERE completed_step = 4 AND report_year = {LOG_YEAR}
"""

INGEST_GAPS = """
SELECT * REPLACE (CASE WHEN oid % 5 <> 0 THEN ctr_header_bestandsnaam END AS ctr_header_bestandsnaam)
FROM ingest
"""


def lambert(source: str, lon: str, lat: str, x: str, y: str) -> str:
    """``source`` with planar metres, the same closed form step by step."""

    def e2(inv_f: float) -> float:
        return (1 / inv_f) * (2 - 1 / inv_f)

    e2w, e2b = e2(geo.WGS84_INV_F), e2(geo.INTL24_INV_F)
    a, m = geo.INTL24_A, 1.0 + geo.SCALE_PPM * 1e-6
    b = a * math.sqrt(1 - e2b)
    rx, ry, rz = (math.radians(s / 3600.0) for s in geo.ROTATION_SEC)
    dx, dy, dz = geo.SHIFT_M
    c = geo.cone()

    def num(v: float) -> str:
        return f"({v!r}::DOUBLE)"

    def step(inner: str, columns: str) -> str:
        return f"SELECT *, {columns} FROM ({inner})"

    q = f"SELECT * FROM {source}"
    q = step(q, f"radians(CAST({lat} AS DOUBLE)) AS phi_, radians(CAST({lon} AS DOUBLE)) AS lam_")
    q = step(q, "sin(phi_) AS sp_, cos(phi_) AS cp_")
    q = step(q, f"{num(geo.WGS84_A)} / sqrt(1 - {num(e2w)} * sp_ * sp_) AS nu_")
    q = step(
        q,
        f"(nu_ * cp_ * cos(lam_) - {num(dx)}) / {num(m)} AS u_, (nu_ * cp_ * sin(lam_) - {num(dy)}) / {num(m)} AS v_, "
        f"(nu_ * {num(1 - e2w)} * sp_ - {num(dz)}) / {num(m)} AS w_",
    )
    q = step(
        q,
        f"u_ + {num(rz)} * v_ - {num(ry)} * w_ AS x_, v_ - {num(rz)} * u_ + {num(rx)} * w_ AS y_, "
        f"w_ + {num(ry)} * u_ - {num(rx)} * v_ AS z_",
    )
    q = step(q, "sqrt(x_ * x_ + y_ * y_) AS p_")
    q = step(q, f"atan2(z_ * {num(a)}, p_ * {num(b)}) AS be_, atan2(y_, x_) AS bl_")
    q = step(
        q,
        f"atan2(z_ + {num(e2b / (1 - e2b) * b)} * pow(sin(be_), 3), p_ - {num(e2b * a)} * pow(cos(be_), 3)) AS bp_",
    )
    q = step(q, f"{num(c.e)} * sin(bp_) AS es_")
    q = step(
        q,
        f"{num(c.scale)} * pow(tan({num(math.pi / 4)} - bp_ / 2) / pow((1 - es_) / (1 + es_), {num(c.e / 2)}), {num(c.n)}) AS r_, "
        f"{num(c.n)} * (bl_ - {num(math.radians(geo.CENTRAL_MERIDIAN))}) AS th_",
    )
    q = step(
        q,
        f"{num(geo.FALSE_EASTING)} + r_ * sin(th_) AS {x}, {num(geo.FALSE_NORTHING)} - r_ * cos(th_) AS {y}",
    )
    drop = "phi_, lam_, sp_, cp_, nu_, u_, v_, w_, x_, y_, z_, p_, be_, bl_, bp_, es_, r_, th_"
    return f"SELECT * EXCLUDE ({drop}) FROM ({q})"


POINT = f"""
SELECT *, CAST(round_even(mx, 0) AS INTEGER) AS x_coord, CAST(round_even(my, 0) AS INTEGER) AS y_coord,
  concat(latitude_start, ',', longitude_start) AS start_coord, concat(latitude_eind, ',', longitude_eind) AS eind_coord
FROM ({lambert("measurement", "longitude_start", "latitude_start", "mx", "my")})
WHERE year(tijdstip_meting) = {SURVEY_YEAR}
"""

KAART_OFFSET = """(CASE left(markering, 2) WHEN 'M1' THEN 2000 WHEN 'M2' THEN 1000 END
  * CASE right(ident8, 1) WHEN '1' THEN 1 WHEN '2' THEN -1 END)"""

LINE_ALL = f"""
SELECT *, sqrt((mx - ex) * (mx - ex) + (my - ey) * (my - ey)) AS lengte,
  CAST({KAART_OFFSET} AS INTEGER) AS kaart_offset
FROM ({lambert("point", "longitude_eind", "latitude_eind", "ex", "ey")})
"""

WEGCAT = """
SELECT m.*, s.district, s.provincie, s.wegcategorie
FROM measurement m JOIN enriched s ON m.ident8 = s.ident8 AND m.kmp BETWEEN s.beginpositie AND s.eindpositie
"""


def _klasse(table: str, condition: str) -> str:
    return f"""
SELECT w.*, c.* EXCLUDE (l_min, l_max),
  CASE right(ident8, 1) WHEN '1' THEN 1000 WHEN '2' THEN -1000 END AS offset_1000
FROM wegcat w JOIN {table} c ON rl BETWEEN c.l_min AND c.l_max WHERE {condition}
"""


KEYED_URL = "'survey/' || ident8 || '/' || meting_serie_naam || '.xls'"

VIEWS: dict[str, tuple[list[str], str]] = {
    "measurement": ([], MEASUREMENT),
    "segment": ([], SEGMENT),
    "enriched": (["segment"], ENRICHED),
    "klasse": ([], _class_view("('A', 0, 49), ('B', 50, 99), ('C', 100, 199), ('D', 200, 9999)")),
    "klasse_p": ([], _class_view("('A', 0, 79), ('B', 80, 119), ('C', 120, 179), ('D', 180, 9999)")),
    "file_log": ([], FILE_LOG),
    "ingest": (["file_log"], INGEST),
    "ingest_gaps": (["ingest"], INGEST_GAPS),
    "point": (["measurement"], POINT),
    "line_all": (["point"], LINE_ALL),
    "line": (["line_all"], "SELECT * FROM line_all WHERE lengte BETWEEN 0 AND 100"),
    "wegcat": (["measurement", "enriched"], WEGCAT),
    "r2": (["wegcat", "klasse"], _klasse("klasse", "rl <> 0")),
    "r4": (["wegcat", "klasse"], _klasse("klasse", "rl <> 0 AND wegcategorie LIKE 'H%'")),
    "r5": (["wegcat", "klasse_p"], _klasse("klasse_p", "rl <> 0 AND wegcategorie LIKE 'P%'")),
}

# --- sources ----------------------------------------------------------------

_TREE = "SELECT DISTINCT CAST(oid % 20 AS VARCHAR) AS weg, markering AS reeks FROM measurement"
ORACLE["file_catalog"] = with_views(
    "measurement",
    body=f"""SELECT 'reeks=' || reeks AS parent_name, 'weg=' || weg AS above, 2::INTEGER AS level FROM ({_TREE})
UNION ALL SELECT 'los', NULL, 1""",
)
ORACLE["folder_catalog"] = with_views(
    "measurement",
    body=f"""SELECT way, 'reeks=M1' AS name, weg FROM ({_TREE}), (VALUES ('files'), ('tree')) w(way) WHERE reeks = 'M1'
UNION ALL SELECT way, 'weg=3', '3' FROM (VALUES ('files'), ('tree')) w(way)
UNION ALL SELECT 'tree', 'leeg', CAST(3 * i AS VARCHAR) FROM range(7) t(i)
UNION ALL SELECT 'under', 'leeg', '3'""",
)
ORACLE["folder_tree"] = with_views(
    "measurement",
    body=f"""SELECT CAST(NULL AS VARCHAR) AS name, 'reeks=' || reeks AS above, 2::INTEGER AS level, false AS is_folder FROM ({_TREE})
UNION ALL SELECT 'reeks=' || reeks, 'weg=' || weg, 1, true FROM ({_TREE})
UNION ALL SELECT DISTINCT 'weg=' || weg, NULL, 0, true FROM ({_TREE})
UNION ALL SELECT 'los', NULL, 0, true UNION ALL SELECT 'leeg', NULL, 0, true UNION ALL SELECT 'dieper', 'leeg', 1, true""",
)
ORACLE["file_catalog_search"] = with_views(
    "measurement",
    body=f"""SELECT weg, reeks, ending, part FROM ({_TREE}), (VALUES ('.csv'), ('v')) e(ending), (VALUES ('reeks=M1'), ('=M2R/')) p(part)
WHERE CASE part WHEN 'reeks=M1' THEN reeks LIKE 'M1%' ELSE reeks = 'M2R' END""",
)

ORACLE["survey_parse_header"] = with_views(
    "measurement",
    body="\nUNION ALL\n".join(
        f"SELECT DISTINCT {KEYED_URL} AS bestands_url, '{key}' AS key, {name} AS value FROM measurement"
        for key, name in HEADER_KEYS.items()
    ),
)


def _parsed(marker: str, text_time: str) -> str:
    special = {
        "bestands_url": f"{KEYED_URL} AS bestands_url",
        "tijdstip_meting": "date_trunc('second', tijdstip_meting) AS tijdstip_meting",
        "tijdstip_meting_tekst": f"{text_time} AS tijdstip_meting_tekst",
        "marker": f"{marker} AS marker",
    }
    names = [n for n in MEASUREMENT_RAW.names if n not in ("oid", "inleesdatum")]
    columns = ", ".join(special.get(n, cols([n])) for n in names)
    return with_views("measurement", body=f"SELECT {columns}, oid + 100 AS line_no FROM measurement")


def _noisy(value: str) -> str:
    return f"CASE WHEN oid % 50 = 0 THEN 'Obstakel' WHEN oid % 50 = 1 THEN {value} ELSE '-' END"


DAY_FIRST = "strftime(tijdstip_meting, '%d/%m/%Y %H:%M:%S')"
ORACLE["survey_parse_body"] = _parsed(_noisy("'a' || chr(9) || 'b\\c'"), "tijdstip_meting_tekst")
ORACLE["survey_parse_semicolon"] = _parsed(_noisy("'ab\\c'"), "tijdstip_meting_tekst")
ORACLE["survey_parse_positional"] = _parsed("marker", DAY_FIRST)

# Every second road is in files of the positional layout.
_ODD = "CAST(substr(meting_serie_naam, 8, 1) AS INTEGER) % 2 = 1"
ORACLE["survey_mixed_layouts"] = _parsed(
    f"CASE WHEN {_ODD} THEN marker ELSE {_noisy("'a' || chr(9) || 'b\\c'")} END",
    f"CASE WHEN {_ODD} THEN {DAY_FIRST} ELSE tijdstip_meting_tekst END",
)

_WHOLE_FILE = {n: f"max({n}) OVER f AS {n}" for n in HEADER_KEYS.values()} | {
    "bestands_url": "'survey/B' || oid % 2 || '/B' || oid % 2 || ' M1.xls' AS bestands_url",
    "meting_serie_naam": "'B' || oid % 2 || ' M1' AS meting_serie_naam",
    "locatieomschrijving": "'café aan de Schöne straße' AS locatieomschrijving",
    "tijdstip_meting": "date_trunc('second', tijdstip_meting) AS tijdstip_meting",
    "marker": _noisy("'a' || chr(9) || 'b\\c'") + " AS marker",
}
ORACLE["survey_semicolon_round_trip"] = with_views(
    "measurement",
    body=f"""SELECT {", ".join(_WHOLE_FILE.get(n, cols([n])) for n in MEASUREMENT_RAW.names if n not in ("oid", "inleesdatum"))},
  {len(HEADER_KEYS) + 2} + row_number() OVER (f ORDER BY oid) AS line_no
FROM measurement WINDOW f AS (PARTITION BY oid % 2)""",
)

_FILE_SUMS = with_views(
    "measurement",
    body="""SELECT 'B' || lpad(CAST(oid // 1000 AS VARCHAR), 7, '0') || ' M1' AS meting_serie_naam,
  count(*) AS n, CAST(sum(rl) AS BIGINT) AS rl, CAST(sum(kmp) AS DOUBLE) AS kmp,
  min(date_trunc('second', tijdstip_meting)) AS first_at, max(date_trunc('second', tijdstip_meting)) AS last_at
FROM measurement GROUP BY 1""",
)
_FILES = """
SELECT 'B' || lpad(CAST(oid // 1000 AS VARCHAR), 7, '0') || ' M1' AS file,
  CASE oid // 1000 % 8 WHEN 1 THEN 'no header end' WHEN 3 THEN 'no column row' WHEN 5 THEN 'no series name' ELSE 'ok' END AS outcome,
  CASE WHEN oid // 1000 % 8 <> 1 THEN max(toestel) END AS toestel,
  CASE WHEN oid // 1000 % 8 IN (1, 3, 5) THEN 0 ELSE count(*) END AS n_good,
  CASE WHEN oid // 1000 % 8 = 5 THEN count(*) ELSE 0 END AS n_bad
FROM measurement GROUP BY oid // 1000
"""
_IN_FILES = _WHOLE_FILE | {
    "meting_serie_naam": "'B' || lpad(CAST(oid // 1000 AS VARCHAR), 7, '0') || ' M1' AS meting_serie_naam",
    "locatieomschrijving": "max(locatieomschrijving) OVER f AS locatieomschrijving",
    "markering": "'M1' AS markering",
}
ORACLE["survey_read_all_columns"] = with_views(
    "measurement",
    body=f"""SELECT * FROM (
  SELECT {", ".join(_IN_FILES.get(n, cols([n])) for n in MEASUREMENT_RAW.names if n not in ("oid", "inleesdatum", "bestands_url"))},
    {len(HEADER_KEYS) + 2} + row_number() OVER (f ORDER BY oid) AS line_no
  FROM measurement WINDOW f AS (PARTITION BY oid // 1000))
CROSS JOIN (VALUES ('whole'), ('lines'), ('stream')) w(way)""",
)
ORACLE["stream_ingest_outcomes"] = with_views("measurement", body=_FILES)
ORACLE["survey_file_outcomes"] = with_views(
    "measurement", body=f"SELECT * FROM ({_FILES}) CROSS JOIN (VALUES ('whole'), ('lines')) w(way)"
)
ORACLE["stream_first_name"] = with_views(
    "measurement",
    body="""SELECT oid // 1000 AS file, CASE WHEN oid // 1000 BETWEEN 3 AND 7 THEN 'ok' ELSE 'name taken' END AS outcome,
  CASE WHEN oid // 1000 BETWEEN 3 AND 7 THEN count(*) ELSE 0 END AS n
FROM measurement GROUP BY oid // 1000""",
)
for _name in ("survey_read_files", "survey_read_large_files", "stream_ingest"):
    ORACLE[_name] = _FILE_SUMS

_SEGMENT = """SELECT id, ident8, CAST(beginpositie AS DOUBLE) AS beginopschrift, CAST(NULL AS DOUBLE) AS beginafstand,
  CAST(beginpositie AS DOUBLE) AS beginpositie, CAST(eindpositie AS DOUBLE) AS eindopschrift,
  CAST(NULL AS DOUBLE) AS eindafstand, CAST(eindpositie AS DOUBLE) AS eindpositie, gebied, eigenbeheer,
  {} AS opmerking, CAST(10 AS DOUBLE) AS lengte, CAST(NULL AS DOUBLE) AS werkelijkelengte,
  'beheer' AS gebruiker, TIMESTAMP '2024-01-02 03:04:05' AS opnamedatum, TIMESTAMP '2024-01-02 00:00:00' AS begindatum,
  CAST(NULL AS TIMESTAMP) AS creatiedatum, CAST(NULL AS TIMESTAMP) AS wijzigingsdatum,
  CAST(NULL AS DOUBLE) AS deltawijzigingsdatum, CAST(id % 9 AS INTEGER) AS bronid, wegcategorie,
  CAST(id % 5 - 2 AS INTEGER) AS offset_, TIMESTAMP '2024-02-03 04:05:06' AS copydatum{}
FROM segment"""
ORACLE["segment_load"] = with_views(
    "segment",
    body=_SEGMENT.format("""'zie "plan"' || chr(9) || id""", ", multi_line") + " CROSS JOIN (VALUES (false), (true)) w(multi_line)",
)
_REMARK = """CASE id % 3 WHEN 0 THEN 'zie "plan"' || chr(10) || chr(9) || '"deel" ' || id || chr(10)
  WHEN 1 THEN chr(10) || chr(10) || '"' || id || '"' || chr(92) ELSE CAST(id AS VARCHAR) END"""
ORACLE["segment_load_quoted_breaks"] = with_views("segment", body=_SEGMENT.format(_REMARK, ""))

ORACLE["class_bands_values"] = with_views(
    "measurement",
    "klasse",
    body="""SELECT klasse, l_min, l_max, count(*) AS n FROM measurement JOIN klasse ON rl BETWEEN l_min AND l_max
GROUP BY ALL""",
)

# --- sinks ------------------------------------------------------------------

ORACLE["sink_refresh"] = with_views(
    "measurement",
    body=f"""SELECT {cols(["oid", "kmp", "rl"])}, CAST(2023 AS INTEGER) AS report_year FROM measurement
UNION ALL SELECT {cols(["oid", "kmp", "rl"])}, CAST(2024 AS INTEGER) FROM measurement WHERE rl <> 0""",
)
ORACLE["sink_create_if_absent"] = with_views(
    "measurement", body=f"SELECT {cols(['oid', 'kmp', 'rl'])} FROM measurement"
)
_LINE_PLAIN = [c for c in LINE_COLUMNS if c != "geom_line"]
ORACLE["line_empty_schema"] = with_views("line", body=f"SELECT {cols(_LINE_PLAIN)}, oid AS line_no FROM line WHERE 1 = 2")
ORACLE["sink_append"] = with_views("measurement", body=f"SELECT {cols(MEASUREMENT_RAW.names)} FROM measurement")

_COMMA_TIME = f"CASE WHEN oid % 3 = 0 THEN tijdstip_meting_tekst ELSE {DAY_FIRST} END"


def _comma(name: str) -> str:
    return f"replace(CAST({name} AS VARCHAR), '.', ',')"


def _photo(step: int, first: str, second: str) -> str:
    return f"CASE WHEN oid % {step} = 0 THEN '{first}' || oid || '.jpg{second}' || oid || '.jpg' ELSE '-' END"


def body_texts(marker: str) -> list[str]:
    return [
        _comma("kmp"), _COMMA_TIME, "CAST(rl AS VARCHAR)", "CAST(rlmin AS VARCHAR)", "CAST(rlmax AS VARCHAR)",
        "CAST(rlstddev AS VARCHAR)", "CAST(rlprocpass AS VARCHAR)", marker, "CAST(temperatuur AS VARCHAR)",
        "CAST(vochtigheid AS VARCHAR)", _comma("snelheid"), "reference", _comma("longitude_start"),
        _comma("latitude_start"), _comma("longitude_eind"), _comma("latitude_eind"), "'-'", _photo(4, "a", "b"),
        "'-'", _photo(8, "c", "d"), _photo(16, "e", "f"), "'-'",
    ]


_HEAD_LINES = ["'Remarks:;oud'", *[f"'{k};' || {n}" for k, n in HEADER_KEYS.items()], "' ;'", f"'{';'.join(BODY_COLUMNS)}'"]
ORACLE["survey_normalized_lines"] = with_views(
    "measurement",
    body="\nUNION ALL\n".join(
        [
            *[
                f"SELECT {KEYED_URL} AS bestands_url, {line} AS value FROM (SELECT DISTINCT ident8, {', '.join(HEADER_KEYS.values())} FROM measurement)"
                for line in _HEAD_LINES
            ],
            f"SELECT {KEYED_URL}, concat_ws(';', {', '.join(body_texts(_noisy(chr(39) + 'a' + chr(39) + ' || chr(9) || ' + chr(39) + 'b' + chr(92) * 2 + 'c' + chr(39))))}) FROM measurement",
        ]
    ),
)

_NAMES_2024 = [*BODY_COLUMNS[:10], "Speed km/h km/h", *BODY_COLUMNS[11:16]]
_TEXTS_2024 = body_texts(_noisy("'a' || chr(9) || 'b\\c'"))[:16]
_COMBINED = with_views(
    "measurement",
    body="SELECT oid + 100 AS line_no, meting_serie_naam, ident8, left(markering, 2) AS markering, "
    + ", ".join(f'{t} AS "{n}"' for n, t in zip(_NAMES_2024, _TEXTS_2024))
    + " FROM measurement WHERE rl <> 0 AND NOT regexp_matches(ident8, '[05][12]$')",
)
ORACLE["survey_combined_2024"] = _COMBINED
ORACLE["sink_combined_csv"] = _COMBINED.replace("SELECT oid + 100 AS line_no", "SELECT CAST(oid + 100 AS VARCHAR) AS line_no")
ORACLE["survey_tag_rows_2024"] = with_views(
    "measurement",
    body=f"""SELECT {KEYED_URL} AS bestands_url, oid + 100 AS line_no,
  'meting_serie_naam;ident8;markering;{";".join(_NAMES_2024)}' AS names,
  concat_ws(';', meting_serie_naam, ident8, left(markering, 2), {", ".join(_TEXTS_2024)}) AS texts
FROM measurement""",
)
ORACLE["survey_union_years"] = with_views(
    "measurement",
    body=f"""SELECT {cols(["oid", "kmp", "rl"])}, NULL AS marker FROM measurement WHERE tijdstip_meting < TIMESTAMP '{WATERMARK}'
UNION ALL SELECT oid, NULL, rl, marker FROM measurement WHERE tijdstip_meting >= TIMESTAMP '{WATERMARK}'""",
)
_REPAIRED = ";".join([*BODY_COLUMNS[:10], "Speed km/h km/h", *BODY_COLUMNS[11:]])
ORACLE["header_repair"] = ORACLE["survey_normalized_lines"].replace(f"'{';'.join(BODY_COLUMNS)}'", f"'{_REPAIRED}'")

# --- file log ---------------------------------------------------------------

READ_AT = "TIMESTAMP '2024-12-31 12:00:00'"
ORACLE["log_new_files"] = with_views(
    "file_log",
    body=f"""SELECT drive_file_name, drive_file_id, drive_folder_name, drive_folder_id, report_year,
  {READ_AT} AS datetime_utc_read, CAST(3 AS INTEGER) AS completed_step
FROM (SELECT l.*, row_number() OVER (PARTITION BY drive_file_name, report_year
    ORDER BY drive_folder_name || '/' || drive_file_name, drive_file_id) AS rn
  FROM file_log l) t
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM file_log g WHERE g.completed_step = 4
  AND g.drive_file_name = t.drive_file_name AND g.report_year = t.report_year)""",
)
ORACLE["log_new_files_substring"] = with_views(
    "file_log",
    body="""SELECT oid, path FROM (SELECT oid, drive_folder_name || '/' || drive_file_name AS path FROM file_log) n
WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT 'archief/' || drive_folder_name || '/' || drive_file_name || '.oud' AS url
  FROM file_log WHERE completed_step = 4) g WHERE contains(g.url, n.path))""",
)
ORACLE["incremental_watermark"] = with_views(
    "measurement",
    body=f"""SELECT {cols(["oid", "kmp", "rl", "inleesdatum"])} FROM measurement
WHERE inleesdatum > (SELECT max(inleesdatum) FROM measurement WHERE inleesdatum < TIMESTAMP '{WATERMARK}')
  OR (SELECT count(inleesdatum) FROM measurement WHERE inleesdatum < TIMESTAMP '{WATERMARK}') < 1""",
)
_QUEUE = f"report_year = {LOG_YEAR} AND name_conform IS NULL AND completed_step = 3"
ORACLE["work_queue"] = with_views("file_log", body=f"SELECT * FROM file_log WHERE {_QUEUE}")
_CONFORM = """(left(drive_file_name, length(drive_file_name) - 4) = measure_series_name
  AND split_part(measure_series_name, ' ', 1) = drive_folder_name)"""
ORACLE["file_state_transition"] = with_views(
    "file_log",
    body=f"""SELECT * REPLACE (
  CASE WHEN {_QUEUE} AND oid % 3 = 0 THEN measure_series_name || ' nieuw' ELSE measure_series_name END AS measure_series_name,
  CASE WHEN {_QUEUE} THEN oid % 3 <> 0 AND {_CONFORM} ELSE name_conform END AS name_conform,
  CAST(CASE WHEN {_QUEUE} THEN 4 ELSE completed_step END AS INTEGER) AS completed_step) FROM file_log""",
)
ORACLE["ingest_log_build"] = with_views("ingest", body="SELECT * FROM ingest")
ORACLE["conform_files"] = with_views(
    "ingest", body="SELECT bestands_url FROM ingest WHERE ctr_header_bestandsnaam NOT LIKE '%NIET%'"
)
ORACLE["nonconform_files"] = with_views(
    "ingest", body="SELECT bestands_url FROM ingest WHERE ctr_header_bestandsnaam LIKE '%NIET%'"
)
ORACLE["nonconform_count"] = with_views(
    "ingest", body="SELECT count(oid) AS n FROM ingest WHERE ctr_header_bestandsnaam LIKE '%NIET%'"
)
ORACLE["ingested_files"] = with_views("ingest", body="SELECT bestands_url FROM ingest ORDER BY bestands_url")
ORACLE["purge_nonconform_log"] = with_views(
    "ingest_gaps",
    body="SELECT * FROM ingest_gaps WHERE ctr_header_bestandsnaam IS NULL OR ctr_header_bestandsnaam NOT LIKE '%NIET%'",
)
ORACLE["purge_nonconform_measurements"] = with_views(
    "measurement",
    "ingest_gaps",
    body=f"""SELECT {cols(["oid", "bestands_url", "kmp", "rl"])} FROM measurement
WHERE bestands_url NOT IN (SELECT bestands_url FROM ingest_gaps WHERE ctr_header_bestandsnaam LIKE '%NIET%')""",
)
ORACLE["measurement_log_join"] = with_views(
    "measurement",
    "ingest",
    body=f"""SELECT {cols(["oid", "bestands_url", "kmp", "rl", "inleesdatum"], "a.")} FROM measurement a
JOIN ingest b ON b.bestands_url = a.bestands_url
WHERE b.ctr_header_bestandsnaam = 'bestandsnaam conform header / bestandsmap conform header'""",
)
ORACLE["backlog_count"] = with_views(
    "ingest",
    body="SELECT (SELECT count(*) FROM file_log) - (SELECT count(*) FROM ingest) AS n",
)

# --- filters and name checks ------------------------------------------------

ORACLE["filter_survey_year"] = with_views(
    "file_log", body=f"SELECT * FROM file_log WHERE date_part('year', datetime_utc_read) = {LOG_YEAR}"
)
ORACLE["filter_nonzero_rl"] = with_views(
    "measurement",
    body="SELECT * FROM (SELECT oid, CASE WHEN oid % 13 <> 0 THEN rl END AS rl FROM measurement) WHERE rl <> 0",
)
ORACLE["filter_rl_text"] = with_views(
    "measurement",
    body="""SELECT * FROM (SELECT oid, CASE WHEN oid % 5 = 1 THEN rl || ',0' WHEN oid % 5 <> 2 THEN CAST(rl AS VARCHAR) END AS "RL"
FROM measurement) WHERE "RL" IS DISTINCT FROM '0'""",
)
ORACLE["filter_road_category"] = with_views(
    "segment", body="SELECT id, wegcategorie FROM segment WHERE wegcategorie LIKE 'H%' OR wegcategorie LIKE 'P%'"
)
ORACLE["filter_marking_prefix"] = with_views(
    "measurement", body="SELECT oid, markering FROM measurement WHERE markering LIKE 'M1%' OR markering LIKE 'M2%'"
)
ORACLE["name_conformity"] = with_views(
    "file_log",
    body=f"""SELECT oid, drive_file_name, drive_folder_name, measure_series_name, {_CONFORM} AS name_conform
FROM file_log""",
)
ORACLE["name_conformity_2024"] = with_views(
    "file_log",
    body="""SELECT oid, drive_file_name, CASE WHEN split_part(drive_file_name, ' ', 1) <> drive_folder_name THEN 'map'
  WHEN regexp_replace(drive_file_name, '[.][^.]*$', '') IS DISTINCT FROM
    CASE WHEN oid % 11 <> 0 THEN measure_series_name END THEN 'reeks' END AS reason FROM file_log""",
)
ORACLE["name_conformity_status"] = with_views(
    "file_log",
    body="""SELECT oid,
  CASE WHEN left(drive_file_name, length(drive_file_name) - 4) = measure_series_name
    THEN 'bestandsnaam conform header' ELSE ' bestandsnaam NIET conform header' END ||
  CASE WHEN split_part(measure_series_name, ' ', 1) = drive_folder_name
    THEN ' / bestandsmap conform header' ELSE ' / bestandsmap NIET conform header!' END AS status
FROM file_log""",
)

ORACLE["legacy_log_rows"] = with_views(
    "file_log",
    body=f"""SELECT 'H:\\metingen\\Meetjaar {LOG_YEAR}\\in\\' || below AS bestands_url, '\\in\\' || below AS map_bestand,
  left(below, length(below) - 4) AS bestandsnaam, measure_series_name,
  CASE WHEN left(drive_file_name, length(drive_file_name) - 4) = measure_series_name
    THEN 'bestandsnaam conform header' ELSE ' bestandsnaam NIET conform header' END ||
  CASE WHEN split_part(measure_series_name, ' ', 1) = drive_folder_name
    THEN ' / bestandsmap conform header' ELSE ' / bestandsmap NIET conform header!' END AS ctr_header_bestandsnaam,
  {READ_AT} AS inleesdatum
FROM (SELECT *, drive_folder_name || '\\' || drive_file_name AS below FROM file_log)""",
)

# --- scalar expressions -----------------------------------------------------

ORACLE["scalar_left_right"] = with_views(
    "segment",
    body="""SELECT id, left(gebied, 8) AS left8, left(gebied, 2) AS left2, right(gebied, 1) AS right1,
  right(gebied, 6) AS right6, left(right(gebied, 3), 1) AS digit,
  left(right(left(gebied, id % 4), 3), 1) AS digit_short FROM segment""",
)
ORACLE["series_name_slices"] = with_views(
    "measurement",
    body="""SELECT oid, substring(meting_serie_naam, 1, 8) AS road, substring(meting_serie_naam, 10, 2) AS kind,
  split_part(meting_serie_naam, ' ', 1) AS first_word, left(bestands_url, length(bestands_url) - 4) AS stem,
  split_part(bestands_url, '/', 2) AS file_name FROM measurement""",
)
ORACLE["coord_text"] = with_views(
    "measurement",
    body="""SELECT oid, concat(CASE WHEN oid % 5 <> 0 THEN latitude_start END, ',',
  CASE WHEN oid % 7 <> 0 THEN longitude_start END) AS start_coord FROM measurement""",
)
ORACLE["clean_series_name"] = with_views(
    "file_log",
    body="""SELECT oid, CASE WHEN oid % 2 = 0 THEN measure_series_name ELSE measure_series_name || chr(13) END AS no_newline,
  measure_series_name AS no_breaks FROM file_log""",
)
ORACLE["clean_fields"] = (
    """SELECT doc_id, md5(replace(replace(text, '"', ''), ';', '')) AS clean_md5 FROM documents"""
)
ORACLE["decimal_comma"] = """
SELECT event_id, CAST(CAST(CAST(value AS DECIMAL(18,4)) AS DECIMAL(10,2)) AS DOUBLE) AS typed,
  CAST(round(CAST(value AS DECIMAL(18,4))) AS INTEGER) AS whole FROM events"""
_GOOD_TIME = "CASE WHEN oid % 17 <> 0 THEN date_trunc('second', tijdstip_meting) END"
ORACLE["parse_measure_time"] = with_views(
    "measurement",
    body="""SELECT oid, t AS tijdstip_meting, strftime(t, '%Y-%m-%d %H:%M:%S') AS tekst
FROM (SELECT oid, CASE WHEN oid % 3 = 0 OR oid % 17 <> 0 THEN date_trunc('second', tijdstip_meting) END AS t FROM measurement)""",
)
ORACLE["parse_measure_time_legacy"] = with_views(
    "measurement", body=f"SELECT oid, {_GOOD_TIME} AS tijdstip_meting FROM measurement"
)
ORACLE["map_offset"] = with_views(
    "measurement", body=f"SELECT oid, CAST({KAART_OFFSET} AS INTEGER) AS kaart_offset FROM measurement"
)
ORACLE["direction_offset"] = with_views(
    "measurement",
    body="""SELECT oid, CASE WHEN oid % 9 = 0 THEN NULL WHEN right(ident8, 1) = '1' THEN 1000 ELSE -1000 END AS offset_1000
FROM measurement""",
)
_SLOTS = ", ".join(
    f"CASE WHEN event_id % {n + 2} = 0 THEN 'b{n}_' || event_id || '.jpg' WHEN event_id % 11 = {n} THEN '-' END"
    for n in range(6)
)
ORACLE["photo_slots"] = f"""
SELECT event_id, coalesce(used[1], '-') AS naam_foto1, coalesce(used[2], '-') AS naam_foto2
FROM (SELECT event_id, list_filter([{_SLOTS}], lambda s: s IS NOT NULL) AS used FROM events)"""

# --- segments and classes ---------------------------------------------------

ORACLE["segment_enrich"] = with_views(
    "enriched",
    body=f"""SELECT {cols(["id", "ident8", "beginpositie", "eindpositie", "gebied", "eigenbeheer", "wegcategorie", "district", "provincie"])}
FROM enriched""",
)
_WEGCAT = [c for c in WEGCAT_COLUMNS if c != "geoml72"]
_LAST_ROADS = "(CAST(substr(ident8, 2, 6) AS INTEGER) % 10 < 4 OR CAST(substr(ident8, 2, 6) AS INTEGER) % 10 > 5)"
ORACLE["reading_counts_by_file"] = with_views(
    "wegcat",
    body=f"""SELECT CAST(year(tijdstip_meting) AS INTEGER) AS jaar, markering, provincie, left(wegcategorie, 1) AS weg, rl, count(*) AS n
FROM wegcat WHERE rl <> 0 AND {_LAST_ROADS} GROUP BY ALL
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, count(*) FROM wegcat WHERE rl <> 0 AND {_LAST_ROADS}""",
)
ORACLE["segment_interval_join"] = with_views("wegcat", body=f"SELECT {cols(_WEGCAT)} FROM wegcat")
for _name, _table in (("class_band_join", "klasse"), ("class_band_join_p", "klasse_p")):
    ORACLE[_name] = with_views(
        "measurement", _table, body=f"SELECT oid, rl, c.* FROM measurement JOIN {_table} c ON rl BETWEEN l_min AND l_max"
    )

CLS = ", ".join(CLASS_COLUMNS)
YEAR = "CAST(year(tijdstip_meting) AS INTEGER) AS jaar"
ORACLE["class_counts"] = with_views(
    "r2", body=f"SELECT {YEAR}, markering, provincie, {CLS}, count(rl) AS n FROM r2 GROUP BY ALL"
)
ORACLE["share_denominator"] = with_views(
    "r2",
    body="""SELECT provincie, klasse, n, totaal FROM
  (SELECT provincie, klasse, count(*) AS n FROM r2 GROUP BY ALL) a
  JOIN (SELECT provincie AS p, count(*) AS totaal FROM r2 GROUP BY ALL) b ON a.provincie IS NOT DISTINCT FROM b.p""",
)


def _exact(n: str, total: str) -> str:
    return f"({n} * 2000 + {total}) // (2 * {total}) / 10.0::DOUBLE"


def _share(base: str, area: str, keys: list[str], where: str, extra: str = "") -> str:
    """Shares with the total as a subquery per area."""
    key_list = ", ".join(["jaar", *keys, CLS])
    same = " AND d.provincie = r.provincie" if area == "provincie" else ""
    counted = f"""SELECT r.*, (SELECT count(*) FROM {base} d WHERE {where}{same}) AS totaal
FROM (SELECT {YEAR}, {", ".join([*keys, ""])}{CLS}, count(rl) AS n FROM {base} WHERE {where} GROUP BY ALL) r"""
    return with_views(
        base, body=f"SELECT {key_list}{extra}, {_exact('n', 'totaal')} AS percentage_metingen FROM ({counted})"
    )


PROVINCE_SET = "provincie IN ('Antwerpen', 'Vlaams-Brabant', 'West-Vlaanderen', 'Oost-Vlaanderen', 'Limburg')"
ORACLE["class_share_province"] = _share("r2", "provincie", ["provincie"], PROVINCE_SET, ", n, CAST(totaal AS BIGINT) AS totaal")
ORACLE["class_share_marking"] = _share(
    "r2", "provincie", ["provincie", "markering"], f"{PROVINCE_SET} AND markering LIKE 'M1%'", ", n, CAST(totaal AS BIGINT) AS totaal"
)
ORACLE["class_share_region"] = _share("r2", "gebied", [], "1 = 1", ", 'Vlaanderen' AS gebied, n, CAST(totaal AS BIGINT) AS totaal")
ORACLE["share_union_form"] = with_views(
    "r2",
    body="\nUNION\n".join(
        f"""SELECT jaar, {_exact("n", "totaal")} AS percentage_metingen, provincie, {CLS}
FROM (SELECT {YEAR}, provincie, {CLS}, count(rl) AS n, (SELECT count(*) FROM r2 WHERE provincie = '{name}') AS totaal
  FROM r2 WHERE provincie = '{name}' GROUP BY ALL)"""
        for name in ("Antwerpen", "Vlaams-Brabant", "West-Vlaanderen", "Oost-Vlaanderen", "Limburg")
    ),
)

# --- geometry ---------------------------------------------------------------

ORACLE["point_wgs84"] = with_views(
    "measurement",
    body="SELECT oid, CAST(longitude_start AS DOUBLE) AS x, CAST(latitude_start AS DOUBLE) AS y FROM measurement",
)
ORACLE["projection_round_trip"] = with_views("measurement", body="SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_off FROM measurement")
ORACLE["point_lambert72"] = with_views("point", body="SELECT oid, round(mx, 2) AS x, round(my, 2) AS y FROM point")
ORACLE["point_coords_int"] = with_views("point", body="SELECT oid, x_coord, y_coord FROM point")
ORACLE["line_geometry"] = with_views(
    "line_all",
    body="""SELECT oid, round(ex, 2) AS end_x, round(ey, 2) AS end_y, round(mx, 2) AS start_x, round(my, 2) AS start_y
FROM line_all""",
)
ORACLE["line_length"] = with_views("line_all", body="SELECT oid, round(lengte, 3) AS lengte FROM line_all")
ORACLE["line_length_filter"] = with_views("line", body="SELECT oid FROM line")
ORACLE["line_srid_check"] = with_views(
    "line", body="SELECT count(*) AS n_rows, count(*) FILTER (oid % 100 = 0) AS n_violations FROM line"
)
_POINT_PLAIN = [c for c in POINT_COLUMNS if c != "geoml72"]
ORACLE["report_points"] = with_views(
    "point", body=f"SELECT {cols(_POINT_PLAIN)}, oid + 100 AS line_no, round(mx, 2) AS geom_x, round(my, 2) AS geom_y FROM point"
)
ORACLE["report_lines"] = with_views(
    "line", body=f"SELECT {cols([c for c in _LINE_PLAIN if c != 'lengte'])}, round(lengte, 3) AS lengte, oid + 100 AS line_no FROM line"
)

ORACLE["incremental_lines"] = ORACLE["report_lines"]

# --- report tables ----------------------------------------------------------

ORACLE["report_per_district_wegcat"] = with_views(
    "point",
    "enriched",
    body=f"""SELECT {cols([c for c in _WEGCAT if c not in ("district", "provincie", "wegcategorie")], "m.")},
  s.district, s.provincie, s.wegcategorie, round(mx, 2) AS geom_x, round(my, 2) AS geom_y
FROM point m JOIN enriched s ON m.ident8 = s.ident8 AND m.kmp BETWEEN s.beginpositie AND s.eindpositie""",
)
_BASE = {None: "r2", "H": "r4", "P": "r5"}
for _name, _category in CLASS_REPORTS.items():
    ORACLE[f"report_{_name.lower()}"] = with_views(
        _BASE[_category], body=f"SELECT {cols(CLASSIFIED_COLUMNS)} FROM {_BASE[_category]}"
    )
for _name, _report in SHARE_REPORTS.items():
    _where = PROVINCE_SET if _report.area == "provincie" else "1 = 1"
    if _report.marking:
        _where += f" AND markering LIKE '{_report.marking}%'"
    _keys = [*(["provincie"] if _report.area == "provincie" else []), *(["markering"] if _report.marking else [])]
    _extra = "" if _report.area == "provincie" else ", 'Vlaanderen' AS gebied"
    if _report.area == "gebied" and not _report.marking:
        _extra += ", 'M1_M2' AS markering"
    ORACLE[f"report_{_name.lower()}"] = _share(_BASE[_report.category], _report.area, _keys, _where, _extra)


def _body(sql: str, name: str) -> str:
    if name not in SHARE_REPORTS:
        return f"SELECT '{name}' AS report, CAST(count(*) AS VARCHAR) AS line FROM ({sql})"
    shown = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in sorted(share_columns(SHARE_REPORTS[name])))
    return f"SELECT '{name}' AS report, concat_ws('|', {shown}) AS line FROM ({sql})"


ORACLE["sink_report_export"] = "\nUNION ALL\n".join(
    [
        _body(ORACLE["segment_interval_join"], "per_district_wegcat"),
        *[_body(ORACLE[f"report_{n.lower()}"], n) for n in [*CLASS_REPORTS, *SHARE_REPORTS]],
    ]
)


for _name in ("per_district_wegcat", *CLASS_REPORTS):
    ORACLE[f"export_{_name.lower()}"] = ORACLE[f"report_{_name.lower()}"]


# --- order and years --------------------------------------------------------

ORACLE["order_ingested_files"] = with_views(
    "ingest", body="SELECT bestands_url, CAST(row_number() OVER (ORDER BY bestands_url) AS INTEGER) AS place FROM ingest"
)
ORACLE["order_segment_join"] = f"""SELECT ident8, kmp, oid,
  CAST(row_number() OVER (ORDER BY ident8, kmp, oid) AS INTEGER) AS place FROM ({ORACLE["segment_interval_join"]})"""
ORACLE["order_share_report"] = f"""SELECT provincie, markering, klasse,
  CAST(row_number() OVER (ORDER BY provincie, markering, klasse) AS INTEGER) AS place
FROM ({ORACLE["report_procent_per_prov_m1"]})"""
ORACLE["points_of_one_year"] = with_views(
    "measurement", body="SELECT oid, tijdstip_meting FROM measurement WHERE oid % 4 <> 0 AND year(tijdstip_meting) = 2024"
)
