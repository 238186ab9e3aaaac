"""Reference SQL (DuckDB dialect) for the value checks of the query catalog.

Every text here runs in DuckDB over the provided tables and recomputes a
query's result independently of the Spark code: the raw crash fixture is
projected from ``orders`` by the same SQL, and the cleaning rules are
restated in SQL. Only fixed rule values (bucket lists, drop list, rename
map) are shared with the Spark side.
"""

from __future__ import annotations

from roadframe import schema as S
from roadframe.sources.fixture import fixture_sql


def q(name: str) -> str:
    """Quote an identifier for DuckDB."""
    return '"' + name.replace('"', '""') + '"'


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def bucket_sql(expr: str) -> str:
    """First-match CASE over the factor buckets; unlisted values pass through."""
    whens = " ".join(
        f"WHEN {expr} IN ({', '.join(lit(m) for m in members)}) THEN {lit(label)}"
        for label, members in S.FACTOR_BUCKETS.items()
    )
    return f"CASE {whens} ELSE {expr} END"


def int_sql(expr: str, sql_type: str = "INTEGER") -> str:
    """Text to integer as type inference and an integer cast give it: the
    whole part of a number (blanks and control characters around it are
    ignored), cut toward zero, NULL when the text is no number or out of
    range. Stated explicitly because DuckDB's own cast rounds "12.5"."""
    text = f"CAST({expr} AS VARCHAR)"
    pad = r"[\x00-\x20]*"
    number = r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    return (f"CASE WHEN regexp_full_match({text}, '{pad}[+-]?[0-9]+{pad}') "
            f"THEN TRY_CAST(regexp_extract({text}, '[+-]?[0-9]+') AS {sql_type}) "
            f"WHEN regexp_full_match({text}, '{pad}{number}{pad}') "
            f"THEN TRY_CAST(trunc(TRY_CAST(regexp_extract({text}, '{number}') AS DOUBLE)) AS {sql_type}) END")


def date_sql(expr: str) -> str:
    """The cleaning rule for MM/dd/yyyy text: exactly two-digit month and day
    and four-digit year forming a real date, else NULL (DuckDB's strptime
    alone also accepts unpadded fields)."""
    return (f"CASE WHEN regexp_full_match({expr}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
            f"THEN CAST(try_strptime({expr}, '%m/%d/%Y') AS DATE) END")


def sum_sql(terms: list[str]) -> str:
    """BIGINT sum where a NULL term makes the result NULL."""
    return " + ".join(f"CAST({t} AS BIGINT)" for t in terms)


def half_up_ratio_sql(part: str, whole: str, digits: int = 2) -> str:
    """part / whole (whole > 0) rounded half away from zero, as Spark's
    ``round`` does, with exact integer arithmetic on the magnitude."""
    scale = 10 ** digits
    magnitude = (f"(2 * {scale} * abs(CAST({part} AS BIGINT)) + CAST({whole} AS BIGINT)) // "
                 f"(2 * CAST({whole} AS BIGINT))")
    return f"CAST(sign(CAST({part} AS BIGINT)) * {magnitude} AS DOUBLE) / {scale}"


RAW_CTE = f"fx AS ({fixture_sql('duckdb')}), raw AS (SELECT * EXCLUDE (_k) FROM fx)"

_INT = {c: int_sql(q(c)) for c in S.COUNT_COLUMNS}
_TOTAL_INJ = sum_sql([f"n_{i}" for i in range(0, 8, 2)])
_TOTAL_KIL = sum_sql([f"n_{i}" for i in range(1, 8, 2)])

# raw columns plus every derived column, before any row is removed
_DERIVED_BODY = f"""
d1 AS (
  SELECT *,
    {date_sql(q(S.CRASH_DATE))} AS d_date,
    {int_sql(f"split_part({q(S.CRASH_TIME)}, ':', 1)")} AS d_hour,
    {", ".join(f"{_INT[c]} AS n_{i}" for i, c in enumerate(S.COUNT_COLUMNS))},
    {int_sql(q(S.COLLISION_ID), "BIGINT")} AS d_key
  FROM raw
), d2 AS (
  SELECT *,
    CAST(year(d_date) AS INTEGER) AS d_year,
    CAST(month(d_date) AS INTEGER) AS d_month,
    CAST(dayofweek(d_date) + 1 AS INTEGER) AS d_dow,
    CASE WHEN d_hour < 6 THEN 'night' WHEN d_hour < 12 THEN 'morning'
         WHEN d_hour < 18 THEN 'afternoon' ELSE 'evening' END AS d_segment,
    {_TOTAL_INJ} AS d_injured,
    {_TOTAL_KIL} AS d_killed,
    CASE WHEN {q(S.VEHICLE_COLUMNS[4])} IS NOT NULL THEN 5
         WHEN {q(S.VEHICLE_COLUMNS[3])} IS NOT NULL THEN 4
         WHEN {q(S.VEHICLE_COLUMNS[2])} IS NOT NULL THEN 3
         WHEN {q(S.VEHICLE_COLUMNS[1])} IS NOT NULL THEN 2 ELSE 1 END AS d_cars
  FROM d1
), d3 AS (
  SELECT *, {sum_sql(['d_killed', 'd_injured'])} AS d_hurt FROM d2
), derived AS (
  SELECT *,
    CASE WHEN d_hurt > 0 THEN {half_up_ratio_sql('d_killed', 'd_hurt')} ELSE 0.0 END AS d_rate
  FROM d3
)"""
DERIVED_CTE = RAW_CTE + "," + _DERIVED_BODY

_CLEAN_COLS = {
    "borough": q(S.BOROUGH),
    "zip_code": int_sql(q(S.ZIP_CODE)),
    **{S.RENAME_MAP[c]: f"n_{i}" for i, c in enumerate(S.COUNT_COLUMNS)},
    **{S.RENAME_MAP[c]: bucket_sql(f"coalesce({q(c)}, {lit(S.FACTOR_DEFAULT)})") for c in S.BUCKETED_FACTORS},
    "crash_id": "d_key",
    "year": "d_year", "month": "d_month", "day_of_week": "d_dow",
    "time_segment": "d_segment", "total_injured": "d_injured", "total_killed": "d_killed",
    "fatality_rate": "d_rate", "total_cars": "d_cars",
}

# the 22-column clean frame
_CLEAN_BODY = f"""
kept AS (
  SELECT {", ".join(f"{expr} AS {name}" for name, expr in _CLEAN_COLS.items())}
  FROM derived
  WHERE d_cars < 4 AND {q(S.BOROUGH)} IS NOT NULL AND {q(S.ZIP_CODE)} IS NOT NULL
), clean AS (
  SELECT * FROM kept WHERE {" AND ".join(f"{name} IS NOT NULL" for name in S.CLEAN_COLUMNS)}
)"""
CLEAN_CTE = DERIVED_CTE + "," + _CLEAN_BODY


def clean_sql_over(table: str) -> str:
    """The clean frame computed from a raw crash table named ``table``."""
    return f"WITH raw AS (SELECT * FROM {table}),{_DERIVED_BODY},{_CLEAN_BODY}\nSELECT * FROM clean"


def with_raw(select: str) -> str:
    return f"WITH {RAW_CTE}\n{select}"


def with_derived(select: str) -> str:
    return f"WITH {DERIVED_CTE}\n{select}"


def with_clean(select: str) -> str:
    return f"WITH {CLEAN_CTE}\n{select}"


def split_bucket_sql(key_expr: str, seed: int | str = 42, buckets: int = 100) -> str:
    """md5 bucket of ``seed:key``: first 8 hex digits as a number, mod ``buckets``."""
    return (f"CAST(CAST(('0x' || substr(md5('{seed}:' || CAST({key_expr} AS VARCHAR)), 1, 8)) AS BIGINT)"
            f" % {buckets} AS INTEGER)")


def frequency_rank_sql(value_expr: str, source: str, name: str) -> str:
    """CTE body: every distinct value of ``value_expr`` in ``source`` with its
    index by descending count, ties by text ascending (0-based, as double)."""
    return (
        f"SELECT v AS {name}_value, CAST(row_number() OVER (ORDER BY cnt DESC, v) - 1 AS DOUBLE) AS {name}_idx "
        f"FROM (SELECT CAST({value_expr} AS VARCHAR) AS v, count(*) AS cnt FROM {source} "
        f"WHERE {value_expr} IS NOT NULL GROUP BY 1)"
    )


def tree_ctes(name: str, source: str, features: list[str], classify: bool, depth: int) -> str:
    """CTEs that grow a tree level by level from histograms: every split lies
    midway between two neighbouring values of the whole source, the one of the
    largest weighted gain is taken (first feature, then lowest threshold), and
    a split whose two leaves answer alike is taken back.

    ``source`` has ``id``, the features and ``y``: the class index (from 0) or
    the number to predict. The last two CTEs are ``<name>_nodes`` (path of L
    and R from the root, feature, threshold, gain times rows, rows, value; the
    feature is null for a leaf) and ``<name>_rows`` (id, path of its leaf)."""
    n = name
    group = ", y" if classify else ""
    weight, total = ("count(*)", "count(*)") if classify else ("count(*)", "sum(y)")
    unpivot = " UNION ALL ".join(f"SELECT id, {i} AS f, CAST({x} AS DOUBLE) AS v, y FROM {source}" for i, x in enumerate(features))
    out = [
        f"{n}_v AS MATERIALIZED ({unpivot})",
        f"{n}_t AS MATERIALIZED (SELECT f, (v + nv) / 2 AS t FROM (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nv "
        f"FROM (SELECT DISTINCT f, v FROM {n}_v)) WHERE nv IS NOT NULL)",
        f"{n}_a0 AS MATERIALIZED (SELECT id, '' AS path, y FROM {source})",
    ]
    for d in range(depth):
        out += [
            f"{n}_h{d} AS MATERIALIZED (SELECT a.path, v.f, v.v{', a.y' if classify else ''}, CAST({weight} AS DOUBLE) AS c, "
            f"CAST({total.replace('y', 'a.y')} AS DOUBLE) AS s "
            f"FROM {n}_a{d} a JOIN {n}_v v ON v.id = a.id WHERE length(a.path) = {d} GROUP BY ALL)",
            f"{n}_k{d} AS (SELECT h.path, h.f, t.t{group}, coalesce(sum(c) FILTER (v <= t), 0) AS lc, sum(c) AS nc, "
            f"coalesce(sum(s) FILTER (v <= t), 0) AS ls, sum(s) AS ns FROM {n}_h{d} h JOIN {n}_t t ON t.f = h.f GROUP BY ALL)",
            f"{n}_g{d} AS (SELECT path, f, t, sum(ls * ls) / sum(lc) + sum((ns - ls) * (ns - ls)) / (sum(nc) - sum(lc)) "
            f"- sum(ns * ns) / sum(nc) AS gain FROM {n}_k{d} GROUP BY ALL HAVING sum(lc) > 0 AND sum(nc) > sum(lc))",
            f"{n}_b{d} AS MATERIALIZED (SELECT * FROM {n}_g{d} WHERE gain > 1e-9 "
            f"QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, f, t) = 1)",
            f"{n}_a{d + 1} AS MATERIALIZED (SELECT a.id, CASE WHEN b.path IS NULL THEN a.path WHEN v.v <= b.t THEN a.path || 'L' "
            f"ELSE a.path || 'R' END AS path, a.y FROM {n}_a{d} a LEFT JOIN {n}_b{d} b ON b.path = a.path "
            f"LEFT JOIN {n}_v v ON v.id = a.id AND v.f = b.f)",
        ]
    answer = ("CAST(arg_min(y, struct_pack(a := -c, b := y)) AS DOUBLE)" if classify else "sum(s) / sum(c)")
    inner = (f"SELECT p, y, CAST(count(*) AS DOUBLE) AS c, 0.0 AS s FROM {n}_p GROUP BY ALL" if classify
             else f"SELECT p, CAST(count(*) AS DOUBLE) AS c, CAST(sum(y) AS DOUBLE) AS s FROM {n}_p GROUP BY ALL")
    out += [
        f"{n}_p AS (SELECT id, y, substr(path, 1, d) AS p FROM {n}_a{depth}, range({depth + 1}) r(d) WHERE d <= length(path))",
        f"{n}_w AS MATERIALIZED (SELECT p AS path, {answer} AS value, CAST(sum(c) AS BIGINT) AS rows FROM ({inner}) GROUP BY p)",
        f"{n}_s{depth} AS (SELECT NULL AS path, NULL AS f, NULL AS t, NULL AS gain WHERE false)",
    ]
    for d in reversed(range(depth)):  # splits that stay, from the deepest level up
        out.append(
            f"{n}_s{d} AS MATERIALIZED (SELECT b.path, b.f, b.t, b.gain FROM {n}_b{d} b JOIN {n}_w l ON l.path = b.path || 'L' "
            f"JOIN {n}_w r ON r.path = b.path || 'R' WHERE l.value <> r.value "
            f"OR EXISTS (SELECT 1 FROM {n}_s{d + 1} x WHERE x.path IN (b.path || 'L', b.path || 'R')))")
    kept = " UNION ALL ".join(f"SELECT * FROM {n}_s{d}" for d in range(depth))
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(features)) + " END"
    out += [
        f"{n}_kept AS MATERIALIZED ({kept})",
        f"{n}_nodes AS MATERIALIZED (SELECT w.path, {names} AS feature, k.t AS threshold, k.gain, w.rows, w.value FROM {n}_w w "
        f"LEFT JOIN {n}_kept k ON k.path = w.path WHERE w.path = '' "
        f"OR substr(w.path, 1, length(w.path) - 1) IN (SELECT path FROM {n}_kept))",
        f"{n}_rows AS (SELECT a.id, max_by(m.path, length(m.path)) AS path FROM {n}_a{depth} a "
        f"JOIN {n}_nodes m ON starts_with(a.path, m.path) GROUP BY a.id)",
    ]
    return ", ".join(out)
