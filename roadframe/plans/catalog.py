"""Query catalog: one named query per operator, each ``(spark, sf_dir) ->
DataFrame``, with the matching DuckDB SQL where the result is deterministic.

Crash queries read the crash fixture landed from ``orders`` (see
``sources.fixture``); the profiling and dedup queries also run on
``lineitem``. Output columns carry the same names on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from roadframe import schema as S
from roadframe.functions import columns as X
from roadframe.operators import dedup, evaluate, features, joins, model_store, models, profile, ranking, splits
from roadframe.operators import transforms as T
from roadframe.plans import cleaning, recipes
from roadframe.plans import oracle as O
from roadframe.session import fresh_shared_path
from roadframe.sources import delimited
from roadframe.sources.fixture import landed_fixture, landed_fixture_path
from roadframe.sources.tables import load_table
from roadframe.streaming.ingest import start_clean_ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_fixture(spark, sf_dir, "parquet")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_crashes(raw(spark, sf_dir))


def key(df: DataFrame) -> DataFrame:
    """Raw frame plus ``crash_id`` (the collision id as bigint)."""
    return df.withColumn("crash_id", X.to_int(S.COLLISION_ID, "bigint"))


_KEY_SQL = O.int_sql(O.q(S.COLLISION_ID), "BIGINT")
_RAW_STAR = ", ".join(O.q(c) for c in S.RAW_COLUMNS)


# --- sources ------------------------------------------------------------------

@register("scan_csv_explicit", O.with_raw(f"SELECT {_RAW_STAR} FROM raw"))
def scan_csv_explicit(spark, sf_dir):
    """The landed crash file read back as CSV with the explicit schema."""
    return landed_fixture(spark, sf_dir, "csv")


@register("scan_csv_inferred")
def scan_csv_inferred(spark, sf_dir):
    """The same CSV with type inference (an extra pass over the file)."""
    return delimited.read_delimited(spark, landed_fixture_path(spark, sf_dir, "csv"), infer=True)


@register("inferred_types", "SELECT * FROM (VALUES ('CRASH DATE', 'string'), ('CRASH TIME', 'string'), "
          "('ZIP CODE', 'string'), ('LATITUDE', 'double'), ('NUMBER OF PERSONS INJURED', 'string'), "
          "('NUMBER OF PERSONS KILLED', 'int'), ('COLLISION_ID', 'int'), ('VEHICLE TYPE CODE 1', 'string')) t(field, type)")
def inferred_types(spark, sf_dir):
    """The types that inference gives some of the columns."""
    inferred = dict(scan_csv_inferred(spark, sf_dir).dtypes)
    names = ["CRASH DATE", "CRASH TIME", "ZIP CODE", "LATITUDE", "NUMBER OF PERSONS INJURED",
             "NUMBER OF PERSONS KILLED", "COLLISION_ID", "VEHICLE TYPE CODE 1"]
    return spark.createDataFrame([(n, inferred[n]) for n in names], "field string, type string")


@register("clean_csv_inferred", O.with_clean("SELECT * FROM clean"))
def clean_csv_inferred(spark, sf_dir):
    """S1+S2 end to end: the crash CSV read with type inference, then the
    cleaning pipeline (inferred int columns pass the int casts unchanged)."""
    raw_inferred = delimited.read_delimited(spark, landed_fixture_path(spark, sf_dir, "csv"), infer=True)
    return cleaning.clean_crashes(raw_inferred)


# Text lines made from orders, in both engines: good rows (some with a quoted
# comma and doubled quotes), rows with a field too few or too many, an open
# quote, and a quoted field that holds a line break.
_LINE_SQL = """SELECT (o_orderkey * 31 + o_custkey) % 29 AS h, cast(o_orderkey AS string) AS a, cast(o_custkey AS string) AS b,
  substring(cast(o_orderdate AS string), 1, 10) AS d, o_orderpriority AS p FROM {orders}"""
_LINE_TEXT = '''CASE WHEN h = 1 THEN concat_ws(',', a, b, d) WHEN h = 2 THEN concat_ws(',', a, b, d, p, 'extra')
  WHEN h = 3 THEN concat_ws(',', a, '"' || b, d, p) WHEN h = 4 THEN concat_ws(',', a, b, d, '"' || p || ', said ""yes"""')
  WHEN h = 5 THEN concat_ws(',', a, b, d, '"' || p || chr(10) || 'second line"') WHEN h = 6 THEN concat_ws(',', a, b, d, '')
  ELSE concat_ws(',', a, b, d, p) END'''
_LINES = "WITH lines AS (" + _LINE_SQL.replace("{orders}", "orders") + ") "
_GOOD_LINE = ("SELECT a AS order_id, b AS customer, d AS day, CASE WHEN h = 4 THEN p || ', said \"yes\"' "
              "WHEN h = 5 THEN p || chr(10) || 'second line' WHEN h = 6 THEN NULL ELSE p END AS note FROM lines WHERE h NOT IN ")
_LINE_SCHEMA = ST.StructType([ST.StructField(name, ST.StringType()) for name in ("order_id", "customer", "day", "note")])


def _checked_csv(spark, sf_dir, multi_line=False):
    """The lines written as text and read back: all but those with a line
    break, or, with ``multi_line``, all but those with an open quote."""
    lines = spark.sql(_LINE_SQL, orders=load_table(spark, sf_dir, "orders")).where("h <> 3" if multi_line else "h <> 5")
    path = fresh_shared_path(spark, "lines")
    lines.select(F.expr(_LINE_TEXT).alias("value")).write.text(path)
    return delimited.read_delimited_checked(spark, path, _LINE_SCHEMA, header=False, multi_line=multi_line)


@register("csv_rows_kept", _LINES + _GOOD_LINE + "(1, 2, 3, 5)")
def csv_rows_kept(spark, sf_dir):
    """The rows of a delimited text that have every field."""
    return _checked_csv(spark, sf_dir)[0]


@register("csv_rows_rejected", _LINES + f"SELECT {_LINE_TEXT} AS record FROM lines WHERE h IN (1, 2, 3)")
def csv_rows_rejected(spark, sf_dir):
    """The text of rows with too few or too many fields or an open quote."""
    return _checked_csv(spark, sf_dir)[1].select("record")


@register("csv_rows_multi_line", _LINES + _GOOD_LINE + "(1, 2, 3)")
def csv_rows_multi_line(spark, sf_dir):
    """Line breaks inside quoted fields, with the opt-in multi-line read."""
    return _checked_csv(spark, sf_dir, multi_line=True)[0]


@register("register_view", O.with_raw("SELECT count(*) AS n_rows FROM raw"))
def register_view(spark, sf_dir):
    """S3: register the raw frame as a session view and count through it."""
    view = delimited.register_view(raw(spark, sf_dir), "crashes_raw")
    return profile.row_count(view)


# a crash id may repeat, so the other columns break ties
_BY_KEY = ["crash_id", *[col for col in S.CLEAN_COLUMNS if col != "crash_id"]]


@register("preview_rows", O.with_clean(f"SELECT * FROM clean ORDER BY {', '.join(_BY_KEY)} LIMIT 10"))
def preview_rows(spark, sf_dir):
    """The first ten clean rows by crash id."""
    return delimited.preview(clean(spark, sf_dir), 10, order_by=_BY_KEY)


@register("preview_first_row", O.with_clean(f"SELECT * FROM clean ORDER BY {', '.join(_BY_KEY)} LIMIT 1"))
def preview_first_row(spark, sf_dir):
    """L2: the first clean row by crash id."""
    return delimited.preview(clean(spark, sf_dir), 1, order_by=_BY_KEY)


# --- projections ----------------------------------------------------------------

_MODEL_1_COLUMNS = [recipes.RECIPES["1a"].label, *recipes.RECIPES["1a"].assembler_order]


@register("project_columns", O.with_clean(f"SELECT {', '.join(_MODEL_1_COLUMNS)} FROM clean"))
def project_columns(spark, sf_dir):
    """Keep a list of columns."""
    return T.project(clean(spark, sf_dir), _MODEL_1_COLUMNS)


_KEPT_RAW = [c for c in S.RAW_COLUMNS if c not in S.DROP_COLUMNS]


@register("drop_columns", O.with_raw(f"SELECT {', '.join(O.q(c) for c in _KEPT_RAW)} FROM raw"))
def drop_columns(spark, sf_dir):
    """Drop the 17-name list (two names are absent and ignored)."""
    return T.drop_columns(raw(spark, sf_dir), S.DROP_COLUMNS)


@register("rename_columns", O.with_raw("SELECT " + ", ".join(
    f"{O.q(c)} AS {O.q(S.RENAME_MAP.get(c, c))}" for c in S.RAW_COLUMNS) + " FROM raw"))
def rename_columns(spark, sf_dir):
    """Bulk rename by map."""
    return T.rename_columns(raw(spark, sf_dir), S.RENAME_MAP)


_CAST_OUT = {"ZIP CODE": "zip_code", **{c: S.RENAME_MAP[c] for c in S.COUNT_COLUMNS}}


@register("cast_int_safe", O.with_raw(
    f"SELECT {_KEY_SQL} AS crash_id, "
    + ", ".join(f"{O.int_sql(O.q(c))} AS {n}" for c, n in _CAST_OUT.items())
    + " FROM raw"))
def cast_int_safe(spark, sf_dir):
    """P5: text to int with null on failure (blank zips, missing counts)."""
    df = T.cast_to_int(raw(spark, sf_dir), list(_CAST_OUT))
    return key(df).select("crash_id", *[X.c(c).alias(n) for c, n in _CAST_OUT.items()])


# --- dates and times ----------------------------------------------------------------

_DATE_SQL = O.with_derived("SELECT d_key AS crash_id, strftime(d_date, '%Y-%m-%d') AS crash_date FROM derived")


def _date_query(spark, sf_dir, via_epoch):
    df = key(raw(spark, sf_dir)).transform(T.add_crash_date, via_epoch=via_epoch)
    return df.select("crash_id", F.date_format("date", "yyyy-MM-dd").alias("crash_date"))


@register("parse_date", _DATE_SQL)
def parse_date(spark, sf_dir):
    """MM/dd/yyyy text to date (shown as ISO text)."""
    return _date_query(spark, sf_dir, via_epoch=False)


@register("parse_date_epoch_roundtrip", _DATE_SQL)
def parse_date_epoch_roundtrip(spark, sf_dir):
    """The same date through epoch seconds and ISO text."""
    return _date_query(spark, sf_dir, via_epoch=True)


@register("date_parts", O.with_derived(
    "SELECT d_key AS crash_id, d_year AS year, d_month AS month, d_dow AS day_of_week FROM derived"))
def date_parts(spark, sf_dir):
    """Year, month, day of week (1 = Sunday)."""
    df = key(raw(spark, sf_dir)).transform(T.add_crash_date).transform(T.add_date_parts)
    return df.select("crash_id", "year", "month", "day_of_week")


@register("extract_hour", O.with_derived("SELECT d_key AS crash_id, d_hour AS hour FROM derived"))
def extract_hour(spark, sf_dir):
    """Hour of an H:mm text."""
    return key(raw(spark, sf_dir)).transform(T.add_hour).select("crash_id", "hour")


@register("time_segment", O.with_derived(
    "SELECT d_key AS crash_id, d_hour AS hour, d_segment AS time_segment FROM derived"))
def time_segment(spark, sf_dir):
    """Hour to night / morning / afternoon / evening."""
    df = key(raw(spark, sf_dir)).transform(T.add_hour).transform(T.add_time_segment)
    return df.select("crash_id", "hour", "time_segment")


# --- totals, rates, vehicle counts ------------------------------------------------------

def _counted(spark, sf_dir):
    return key(raw(spark, sf_dir)).transform(T.cast_to_int, S.COUNT_COLUMNS).transform(T.add_totals)


@register("null_strict_sum", O.with_derived(
    "SELECT d_key AS crash_id, d_injured AS total_injured, d_killed AS total_killed FROM derived"))
def null_strict_sum(spark, sf_dir):
    """Totals where a missing count makes the total missing."""
    return _counted(spark, sf_dir).select("crash_id", "total_injured", "total_killed")


@register("safe_rate", O.with_derived("SELECT d_key AS crash_id, d_rate AS fatality_rate FROM derived"))
def safe_rate(spark, sf_dir):
    """Guarded, rounded fatality rate."""
    return _counted(spark, sf_dir).transform(T.add_fatality_rate).select("crash_id", "fatality_rate")


@register("count_vehicles", O.with_derived("SELECT d_key AS crash_id, d_cars AS total_cars FROM derived"))
def count_vehicles(spark, sf_dir):
    """Highest vehicle-code position that is set."""
    return key(raw(spark, sf_dir)).transform(T.add_vehicle_count).select("crash_id", "total_cars")


@register("filter_max_vehicles", O.with_derived(
    "SELECT d_key AS crash_id, d_cars AS total_cars FROM derived WHERE d_cars < 4"))
def filter_max_vehicles(spark, sf_dir):
    """keep crashes with fewer than four vehicles."""
    df = key(raw(spark, sf_dir)).transform(T.add_vehicle_count).transform(T.filter_max_vehicles)
    return df.select("crash_id", "total_cars")


# --- null handling ----------------------------------------------------------------

@register("require_not_null", O.with_raw(
    f"SELECT {_KEY_SQL} AS crash_id, {O.q(S.BOROUGH)} AS borough, {O.q(S.ZIP_CODE)} AS zip_text FROM raw "
    f"WHERE {O.q(S.BOROUGH)} IS NOT NULL AND {O.q(S.ZIP_CODE)} IS NOT NULL"))
def require_not_null(spark, sf_dir):
    """rows with a borough and a zip text (blank text counts as present)."""
    df = key(raw(spark, sf_dir)).transform(T.require_not_null, [S.BOROUGH, S.ZIP_CODE])
    return df.select("crash_id", X.c(S.BOROUGH).alias("borough"), X.c(S.ZIP_CODE).alias("zip_text"))


@register("drop_incomplete", O.with_derived(
    "SELECT * FROM (SELECT d_key AS crash_id, " + O.int_sql(O.q(S.ZIP_CODE)) + " AS zip_code, "
    "d_injured AS total_injured, d_year AS year FROM derived) "
    "WHERE crash_id IS NOT NULL AND zip_code IS NOT NULL AND total_injured IS NOT NULL AND year IS NOT NULL"))
def drop_incomplete(spark, sf_dir):
    """drop rows with a null in any column."""
    df = cleaning.derive_features(key(raw(spark, sf_dir)))
    df = df.select("crash_id", X.to_int(S.ZIP_CODE).alias("zip_code"), "total_injured", "year")
    return T.drop_incomplete(df)


_FACTOR_OUT = {c: S.RENAME_MAP[c] for c in S.BUCKETED_FACTORS}


@register("fill_defaults", O.with_raw(
    f"SELECT {_KEY_SQL} AS crash_id, "
    + ", ".join(f"coalesce({O.q(c)}, 'Unspecified') AS {n}" for c, n in _FACTOR_OUT.items())
    + " FROM raw"))
def fill_defaults(spark, sf_dir):
    """missing factors default to 'Unspecified'."""
    df = key(raw(spark, sf_dir)).transform(T.fill_factor_defaults)
    return df.select("crash_id", *[X.c(c).alias(n) for c, n in _FACTOR_OUT.items()])


@register("bucketize", O.with_raw(
    f"SELECT {_KEY_SQL} AS crash_id, "
    + ", ".join(f"{O.bucket_sql(O.q(c))} AS {n}" for c, n in _FACTOR_OUT.items())
    + " FROM raw"))
def bucketize(spark, sf_dir):
    """Contributing factors to bucket labels (nulls and unlisted pass)."""
    df = key(raw(spark, sf_dir)).transform(T.bucketize)
    return df.select("crash_id", *[X.c(c).alias(n) for c, n in _FACTOR_OUT.items()])


@register("first_non_null", O.with_raw(
    f"SELECT {_KEY_SQL} AS crash_id, coalesce("
    + ", ".join(O.q(c) for c in S.BUCKETED_FACTORS) + ") AS main_reason FROM raw"))
def first_non_null(spark, sf_dir):
    """C4: first non-null factor, nulls kept."""
    df = key(raw(spark, sf_dir)).transform(T.add_first_non_null, S.BUCKETED_FACTORS, "main_reason")
    return df.select("crash_id", "main_reason")


# --- profiling ----------------------------------------------------------------

@register("distinct_counts", O.with_raw(
    f"SELECT count(DISTINCT {O.q(S.CRASH_TIME)}) AS distinct_crash_time, "
    f"count(DISTINCT {O.q(S.FACTOR_COLUMNS[0])}) AS distinct_factor_v1 FROM raw"))
def distinct_counts(spark, sf_dir):
    """G1: exact distinct counts of two columns in one job."""
    return profile.distinct_counts(raw(spark, sf_dir), [S.CRASH_TIME, S.FACTOR_COLUMNS[0]],
                                   aliases={S.CRASH_TIME: "distinct_crash_time",
                                            S.FACTOR_COLUMNS[0]: "distinct_factor_v1"})


_LINEITEM_DISTINCT = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"]


@register("distinct_counts_approx")
def distinct_counts_approx(spark, sf_dir):
    """G1 approximate form: HyperLogLog++ sketches (relative error 1%), one
    fixed-size sketch per task instead of a shuffle of distinct values."""
    return profile.distinct_counts(load_table(spark, sf_dir, "lineitem"), _LINEITEM_DISTINCT,
                                   approx=True, rsd=0.01)


@register("distinct_counts_approx_check",
          "SELECT " + ", ".join(f"TRUE AS {c}_within_bound" for c in _LINEITEM_DISTINCT))
def distinct_counts_approx_check(spark, sf_dir):
    """G1: each approximate count lies within 5% (five times the stated
    error) of the exact one."""
    lines = load_table(spark, sf_dir, "lineitem")
    exact = profile.distinct_counts(lines, _LINEITEM_DISTINCT, aliases={c: f"e_{c}" for c in _LINEITEM_DISTINCT})
    near = profile.distinct_counts(lines, _LINEITEM_DISTINCT, approx=True, rsd=0.01)
    both = exact.crossJoin(near)  # one row each
    return both.select(*[(F.abs(F.col(f"distinct_{c}") - F.col(f"e_{c}")) <= 0.05 * F.col(f"e_{c}")).alias(
        f"{c}_within_bound") for c in _LINEITEM_DISTINCT])


@register("distinct_counts_lineitem", "SELECT " + ", ".join(
    f"count(DISTINCT {c}) AS distinct_{c}" for c in _LINEITEM_DISTINCT) + " FROM lineitem")
def distinct_counts_lineitem(spark, sf_dir):
    """G1 on a wide table: five exact distinct counts in one pass."""
    return profile.distinct_counts(load_table(spark, sf_dir, "lineitem"), _LINEITEM_DISTINCT)


@register("distinct_values_across", O.with_raw(
    " UNION ".join(f"SELECT {O.q(c)} AS value FROM raw WHERE {O.q(c)} IS NOT NULL"
                   for c in S.FACTOR_COLUMNS)))
def distinct_values_across(spark, sf_dir):
    """The distinct non-null values of the five factor columns."""
    return profile.distinct_values_across(raw(spark, sf_dir), S.FACTOR_COLUMNS)


@register("distinct_values_list", O.with_raw(
    "SELECT string_agg(value, ' | ' ORDER BY value) AS distinct_list FROM ("
    + " UNION ".join(f"SELECT {O.q(c)} AS value FROM raw WHERE {O.q(c)} IS NOT NULL"
                     for c in S.FACTOR_COLUMNS) + ")"))
def distinct_values_list(spark, sf_dir):
    """R1 array form: the distinct factor values as one sorted array, shown
    as one text line (built from the distributed distinct set)."""
    arr = profile.distinct_values_array(raw(spark, sf_dir), S.FACTOR_COLUMNS)
    return arr.select(F.array_join("distinct_list", " | ").alias("distinct_list"))


@register("row_count", O.with_clean("SELECT count(*) AS n_rows FROM clean"))
def row_count(spark, sf_dir):
    """Number of clean rows."""
    return profile.row_count(clean(spark, sf_dir))


@register("dedup_by_key", O.with_clean(
    "SELECT * FROM clean QUALIFY row_number() OVER "
    f"(PARTITION BY crash_id ORDER BY {', '.join(_BY_KEY[1:])}) = 1"))
def dedup_by_key(spark, sf_dir):
    """One clean row per crash id, the smallest by its other columns."""
    return dedup.dedup_by_key(clean(spark, sf_dir), ["crash_id"], order_by=_BY_KEY[1:])


_LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("dedup_by_key_ordered",
          f"SELECT {', '.join(_LINE_COLS)} FROM lineitem "
          "QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, "
          "l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) = 1")
def dedup_by_key_ordered(spark, sf_dir):
    """G6 deterministic form: the highest line number of every order (ties
    broken by the remaining columns, largest first)."""
    lines = load_table(spark, sf_dir, "lineitem").select(*_LINE_COLS)
    return dedup.dedup_by_key(lines, ["l_orderkey"], order_by=["l_linenumber"], descending=True)


@register("clean_pipeline", O.with_clean("SELECT * FROM clean"))
def clean_pipeline(spark, sf_dir):
    """Entry 1: raw crash file to the 22-column clean frame."""
    return clean(spark, sf_dir)


_REMOVED_SQL = ("CASE WHEN d_cars >= 4 THEN 'vehicles' "
                f"WHEN {O.q(S.BOROUGH)} IS NULL THEN 'borough' WHEN {O.q(S.ZIP_CODE)} IS NULL THEN 'zip_code' "
                "WHEN d_date IS NULL THEN 'null_date' "
                + " ".join(f"WHEN n_{i} IS NULL THEN 'null_{S.RENAME_MAP[col]}'" for i, col in enumerate(S.COUNT_COLUMNS))
                + f" WHEN {O.int_sql(O.q(S.ZIP_CODE))} IS NULL THEN 'null_zip_code' WHEN d_key IS NULL THEN 'null_crash_id' "
                "ELSE 'kept' END")


@register("removal_counts", O.with_derived(
    ", reasons AS (SELECT unnest([" + ", ".join(O.lit(r) for r in ["kept", *cleaning.REMOVAL_REASONS]) + "]) AS reason), "
    f"why AS (SELECT {_REMOVED_SQL} AS reason FROM derived) SELECT reasons.reason, count(why.reason) AS rows "
    "FROM reasons LEFT JOIN why ON why.reason = reasons.reason GROUP BY 1"))
def removal_counts(spark, sf_dir):
    """The rows kept and those removed by reason, counted while the
    clean table is written; no second pass over the raw rows."""
    kept, counts = cleaning.clean_crashes_counted(raw(spark, sf_dir))
    kept.write.parquet(fresh_shared_path(spark, "counted-clean"))
    return cleaning.removal_rows(spark, counts)


@register("clean_pipeline_counted", O.with_clean("SELECT * FROM clean"))
def clean_pipeline_counted(spark, sf_dir):
    """Entry 1 with the removals counted in the same pass."""
    return cleaning.clean_crashes_counted(raw(spark, sf_dir))[0]


@register("clean_pipeline_epoch", O.with_clean("SELECT * FROM clean"))
def clean_pipeline_epoch(spark, sf_dir):
    """Entry 1 with the date parsed through epoch seconds and ISO text."""
    return cleaning.clean_crashes(raw(spark, sf_dir), via_epoch=True)


@register("clean_stream", O.with_clean("SELECT * FROM clean"))
def clean_stream(spark, sf_dir):
    """Entry 1 as a stream: the landed CSV files ingested by Structured
    Streaming (available-now trigger) into a fresh Parquet sink, read back."""

    sink = fresh_shared_path(spark, "clean-stream")
    source = landed_fixture_path(spark, sf_dir, "csv")
    start_clean_ingest(spark, source, sink).awaitTermination()  # raises if the stream failed
    return spark.read.schema(clean_stream_schema(spark, source)).parquet(sink)


def clean_stream_schema(spark, source):
    from roadframe.streaming.ingest import clean_stream as stream_of
    return stream_of(spark, source).schema


# --- splits ----------------------------------------------------------------

@register("stable_split", O.with_clean(
    f"SELECT crash_id, CASE WHEN {O.split_bucket_sql('crash_id')} < 80 THEN 0 ELSE 1 END AS part FROM clean"))
def stable_split(spark, sf_dir):
    """X2 layout-proof form: 80/20 by an md5 bucket of the crash id."""
    df = splits.with_split_part(clean(spark, sf_dir), [0.8, 0.2], ["crash_id"], seed=42)
    return df.select("crash_id", "part")


def _random_parts(spark, sf_dir):
    # stored: both parts must see the same rows in the same layout
    rows = models.materialize(clean(spark, sf_dir).withColumn("row", F.monotonically_increasing_id()), "split-input")
    return rows, splits.random_split(rows, [0.8, 0.2], seed=42)


@register("random_split_check", O.with_clean(
    "SELECT count(*) AS n_rows, 0 AS in_both, TRUE AS share_within_bound FROM clean"))
def random_split_check(spark, sf_dir):
    """The parts are disjoint, cover all rows, and the first holds 80% of
    them within five standard deviations."""
    rows, (train, test) = _random_parts(spark, sf_dir)
    parts = train.select("row", F.lit(0).alias("part")).unionByName(test.select("row", F.lit(1).alias("part")))
    by_row = rows.select("row").join(parts, "row").groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("part"))
    n = F.count(F.lit(1))
    return by_row.agg(n.alias("n_rows"), F.count_if(F.col("n") > 1).cast("int").alias("in_both"),
                      (F.abs(F.count_if(F.col("part") == 0) - 0.8 * n) <= 5 * F.sqrt(0.16 * n)).alias("share_within_bound"))


@register("random_split")
def random_split(spark, sf_dir):
    """Spark's seeded Bernoulli split, as part sizes."""
    _, (train, test) = _random_parts(spark, sf_dir)
    return train.select(F.lit(0).alias("part")).unionByName(test.select(F.lit(1).alias("part"))) \
        .groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))


# --- features ----------------------------------------------------------------

_SPLIT_SQL = (f", sp AS (SELECT *, CASE WHEN {O.split_bucket_sql('crash_id')} < 80 THEN 0 ELSE 1 END AS part "
              "FROM clean), tr AS (SELECT * FROM sp WHERE part = 0), te AS (SELECT * FROM sp WHERE part = 1)")
_KEEP_COLS = ["borough", "zip_code", "time_segment"]


def _train_test(spark, sf_dir):
    return splits.stable_split(clean(spark, sf_dir), [0.8, 0.2], ["crash_id"], seed=42)


def _rank_ctes(cols, source):
    return "".join(f", r_{col} AS ({O.frequency_rank_sql(col, source, col)})" for col in cols)


@register("index_categories_keep",
    "WITH " + O.CLEAN_CTE + _SPLIT_SQL + _rank_ctes(_KEEP_COLS, "tr") +
    " SELECT te.crash_id, " + ", ".join(
        f"coalesce(r_{col}.{col}_idx, CAST((SELECT count(*) FROM r_{col}) AS DOUBLE)) AS {col}_idx"
        for col in _KEEP_COLS) +
    " FROM te " + " ".join(
        f"LEFT JOIN r_{col} ON CAST(te.{col} AS VARCHAR) = r_{col}.{col}_value" for col in _KEEP_COLS))
def index_categories_keep(spark, sf_dir):
    """M1/M3: indexer fitted on the training part, applied to the test part;
    values never seen in training get the extra index."""
    train_df, test_df = _train_test(spark, sf_dir)
    model = features.index_categories(_KEEP_COLS, invalid="keep").fit(train_df)
    return model.transform(test_df).select("crash_id", *[col + "_idx" for col in _KEEP_COLS])


@register("index_ranked_keep", ORACLES["index_categories_keep"])
def index_ranked_keep(spark, sf_dir):
    """M1/M3 without a label list: the ranks are joined back."""
    train_df, test_df = _train_test(spark, sf_dir)
    out = ranking.index_by_ranking(test_df, _KEEP_COLS, fit_on=train_df, invalid="keep")
    return out.select("crash_id", *[col + "_idx" for col in _KEEP_COLS])


@register("label_ranking_orders", "SELECT CAST(l_orderkey AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY count(*) DESC, "
          "CAST(l_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS index FROM lineitem GROUP BY l_orderkey")
def label_ranking_orders(spark, sf_dir):
    """M1/M3: every order key of the line items as a category."""
    return ranking.label_ranking(load_table(spark, sf_dir, "lineitem"), "l_orderkey")


_ERROR_COLS = ["borough", "day_of_week"]


@register("index_categories_error",
          "WITH " + O.CLEAN_CTE + _rank_ctes(_ERROR_COLS, "clean") +
          " SELECT clean.crash_id, " + ", ".join(f"r_{col}.{col}_idx" for col in _ERROR_COLS) +
          " FROM clean " + " ".join(
              f"JOIN r_{col} ON CAST(clean.{col} AS VARCHAR) = r_{col}.{col}_value" for col in _ERROR_COLS))
def index_categories_error(spark, sf_dir):
    """M2: indexer in error mode, fitted and applied on the same frame."""
    df = clean(spark, sf_dir)
    model = features.index_categories(_ERROR_COLS, invalid="error").fit(df)
    return model.transform(df).select("crash_id", *[col + "_idx" for col in _ERROR_COLS])


@register("index_numeric_as_text",
          "WITH " + O.CLEAN_CTE + ", r AS (" + O.frequency_rank_sql("zip_code", "clean", "zip_code") + ")"
          " SELECT zip_code_value AS zip_code, zip_code_idx FROM r")
def index_numeric_as_text(spark, sf_dir):
    """M3: a numeric column indexed by its text: (value, index) per zip."""
    df = clean(spark, sf_dir)
    model = features.index_categories(["zip_code"], invalid="error").fit(df)
    return features.index_mapping(model, df, "zip_code")


@register("one_hot_slots",
          "WITH " + O.CLEAN_CTE + _SPLIT_SQL + _rank_ctes(["zip_code"], "tr") +
          _rank_ctes(["day_of_week"], "clean").replace("r_day_of_week", "rd") +
          ", k AS (SELECT (SELECT count(*) FROM r_zip_code) AS kz, (SELECT count(*) FROM rd) AS kd)"
          " SELECT te.crash_id,"
          " CASE WHEN r_zip_code.zip_code_idx IS NULL THEN -1 ELSE CAST(r_zip_code.zip_code_idx AS INTEGER) END AS zip_slot,"
          " CAST(k.kz AS INTEGER) AS zip_width,"
          " CASE WHEN rd.day_of_week_idx < k.kd - 1 THEN CAST(rd.day_of_week_idx AS INTEGER) ELSE -1 END AS dow_slot,"
          " CAST(k.kd - 1 AS INTEGER) AS dow_width"
          " FROM te CROSS JOIN k"
          " LEFT JOIN r_zip_code ON CAST(te.zip_code AS VARCHAR) = r_zip_code.zip_code_value"
          " JOIN rd ON CAST(te.day_of_week AS VARCHAR) = rd.day_of_week_value")
def one_hot_slots(spark, sf_dir):
    """M4: one-hot slots with drop-last. Keep-mode indexer (zip, fitted on
    the training part): k labels give k slots, unseen is all zeros. Error-mode
    indexer (day of week, fitted on all rows): k labels give k-1 slots, the
    least frequent label is all zeros."""
    train_df, test_df = _train_test(spark, sf_dir)
    zip_model = features.index_categories(["zip_code"], invalid="keep").fit(train_df)
    dow_model = features.index_categories(["day_of_week"], invalid="error").fit(clean(spark, sf_dir))
    df = dow_model.transform(zip_model.transform(test_df))
    enc = features.one_hot(["zip_code_idx", "day_of_week_idx"], ["zip_ohe", "dow_ohe"]).fit(df)
    out = enc.transform(df)
    return out.select(
        "crash_id",
        features.one_hot_slot("zip_ohe").alias("zip_slot"), features.vector_width("zip_ohe").alias("zip_width"),
        features.one_hot_slot("dow_ohe").alias("dow_slot"), features.vector_width("dow_ohe").alias("dow_width"),
    )


_ASSEMBLED = ["zip_code", "total_injured", "total_killed", "total_cars", "fatality_rate"]


@register("assemble_skip", O.with_derived(
    "SELECT * FROM (SELECT d_key AS crash_id, CAST(" + O.int_sql(O.q(S.ZIP_CODE)) + " AS DOUBLE) AS e0, "
    "CAST(d_injured AS DOUBLE) AS e1, CAST(d_killed AS DOUBLE) AS e2, CAST(d_cars AS DOUBLE) AS e3, "
    "CAST(d_rate AS DOUBLE) AS e4 FROM derived) "
    "WHERE e0 IS NOT NULL AND e1 IS NOT NULL AND e2 IS NOT NULL AND e3 IS NOT NULL AND e4 IS NOT NULL"))
def assemble_skip(spark, sf_dir):
    """M5/M6: assemble five columns into a vector, skipping rows with nulls."""
    df = cleaning.derive_features(key(raw(spark, sf_dir)))
    df = df.withColumn("zip_code", X.to_int(S.ZIP_CODE)).select("crash_id", *_ASSEMBLED)
    vec = features.assemble(_ASSEMBLED, "features", invalid="skip").transform(df)
    arr = features.vector_elements("features")
    return vec.select("crash_id", *[arr[i].alias(f"e{i}") for i in range(len(_ASSEMBLED))])


# --- metrics ----------------------------------------------------------------
# The metric operators are checked on a deterministic stand-in prediction
# that both engines can compute: the most frequent segment of the crash's
# borough (ties by name) and the borough's mean injured count.

def _majority_prediction(df, group, target):
    counts = df.groupBy(group, target).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("neg_n"), F.col(target))).alias("b"))
    return joins.join_summary(df, best.select(group, F.col(f"b.{target}").alias("predicted")), [group])


@register("classification_metrics", O.with_clean(
    ", m AS (SELECT borough, time_segment AS predicted FROM (SELECT borough, time_segment, count(*) AS n "
    "FROM clean GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY borough ORDER BY n DESC, time_segment) = 1)"
    " SELECT 'accuracy' AS metric, round(avg(CASE WHEN c.time_segment = m.predicted THEN 1.0 ELSE 0.0 END), 6) AS value"
    " FROM clean c JOIN m ON c.borough = m.borough"))
def classification_metrics(spark, sf_dir):
    """Accuracy of indexed predictions against indexed labels."""
    df = _majority_prediction(clean(spark, sf_dir), "borough", "time_segment")
    idx = features.index_categories(["time_segment"], ["label"], invalid="keep").fit(df)
    scored = idx.transform(df)
    # the predicted text is indexed in the label indexer's order
    as_label = StringIndexerModel.from_labels(idx.labelsArray[0], inputCol="predicted",
                                              outputCol="prediction", handleInvalid="keep")
    return evaluate.classification_metrics(as_label.transform(scored), "label", "prediction", digits=6)


@register("regression_metrics", O.with_clean(
    ", m AS (SELECT borough, avg(CAST(total_injured AS DOUBLE)) AS predicted FROM clean GROUP BY 1),"
    " e AS (SELECT CAST(c.total_injured AS DOUBLE) AS y, m.predicted AS p FROM clean c JOIN m ON c.borough = m.borough)"
    " SELECT 'rmse' AS metric, round(sqrt(avg((y - p) * (y - p))), 6) AS value FROM e"
    " UNION ALL SELECT 'r2' AS metric, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS value FROM e"))
def regression_metrics(spark, sf_dir):
    """RMSE and R2 in one aggregation pass."""
    df = clean(spark, sf_dir)
    means = df.groupBy("borough").agg(F.avg(F.col("total_injured").cast("double")).alias("prediction"))
    return evaluate.regression_metrics(joins.join_summary(df, means, ["borough"]), "total_injured",
                                       "prediction", digits=6)


# --- recipe feature vectors ----------------------------------------------------
# What the learners see: each recipe's feature stages fitted on its training
# part and applied to its test part. The fits themselves are rows-only.

def _recipe_features(spark, sf_dir, name):
    recipe = recipes.RECIPES[name]
    train_df, test_df = recipes.split(recipes.model_input(clean(spark, sf_dir), recipe), recipe)
    feature_stages = recipes.stages(recipe)[0][:-1]
    return Pipeline(stages=feature_stages).fit(train_df).transform(test_df)


def _input_sql(recipe):
    """A recipe's model input and its stable split, as CTEs over ``clean``:
    the main reason where it is the label, one row per crash id (the smallest
    by its values) for the deduplicating recipes."""
    cols = [recipe.label, *recipe.categorical, *recipe.numeric]
    source = "(SELECT *, coalesce(factor_v1, factor_v2, factor_v3) AS main_reason FROM clean)"
    one = (f" QUALIFY row_number() OVER (PARTITION BY crash_id ORDER BY {', '.join(cols)}) = 1"
           if recipe.dedup else "")
    bound = round(100 * recipe.weights[0])
    return (f", mi AS (SELECT {', '.join(['crash_id', *cols])} FROM {source}{one})"
            f", sp AS (SELECT *, CASE WHEN {O.split_bucket_sql('crash_id')} < {bound} THEN 0 ELSE 1 END AS part FROM mi)"
            ", tr AS (SELECT * FROM sp WHERE part = 0), te AS (SELECT * FROM sp WHERE part = 1)")


def _recipe_sql(recipe, cols, select):
    return "WITH " + O.CLEAN_CTE + _input_sql(recipe) + _rank_ctes(cols, "tr") + " " + select


def _indexed_sql(recipe):
    """Dense feature vectors of a recipe whose categories are indices."""
    elements = [
        f"coalesce(r_{col}.{col}_idx, CAST((SELECT count(*) FROM r_{col}) AS DOUBLE))"
        if col in recipe.categorical else f"CAST(te.{col} AS DOUBLE)" for col in recipe.assembler_order]
    joins_sql = " ".join(f"LEFT JOIN r_{col} ON CAST(te.{col} AS VARCHAR) = r_{col}.{col}_value"
                         for col in recipe.categorical)
    return _recipe_sql(recipe, list(recipe.categorical), "SELECT te.crash_id, " + ", ".join(
        f"{e} AS e{i}" for i, e in enumerate(elements)) + " FROM te " + joins_sql)


def _one_hot_sql(recipe):
    """Non-zero entries of the feature vectors of a one-hot recipe. Keep mode:
    k labels give k slots and an unseen value none; error mode: k - 1 slots,
    the least frequent label none."""
    last = "" if recipe.index_invalid == "keep" else " - 1"
    offset, parts = "0", []

    def numeric():
        nonlocal offset
        for i, col in enumerate(recipe.numeric):
            parts.append(f"SELECT crash_id, CAST({offset} + {i} AS INTEGER) AS pos, CAST({col} AS DOUBLE) AS value "
                         f"FROM te WHERE {col} <> 0")
        offset += f" + {len(recipe.numeric)}"

    def categories():
        nonlocal offset
        for col in recipe.categorical:
            parts.append(
                f"SELECT te.crash_id, CAST({offset} + r_{col}.{col}_idx AS INTEGER) AS pos, 1.0 AS value FROM te "
                f"JOIN r_{col} ON CAST(te.{col} AS VARCHAR) = r_{col}.{col}_value "
                f"WHERE r_{col}.{col}_idx < (SELECT count(*) FROM r_{col}){last}")
            offset += f" + (SELECT count(*) FROM r_{col}){last}"

    for step in (numeric, categories) if recipe.numeric_first else (categories, numeric):
        step()
    return _recipe_sql(recipe, list(recipe.categorical), " UNION ALL ".join(parts))


def _features_query(recipe):
    dense = recipe.encode == "index"

    def run(spark, sf_dir):
        out = _recipe_features(spark, sf_dir, recipe.name)
        arr = features.vector_elements("features")
        if dense:
            return out.select("crash_id", *[arr[i].alias(f"e{i}") for i in range(len(recipe.assembler_order))])
        # only the non-zero slots become rows
        slots = F.filter(F.transform(arr, lambda v, i: F.struct(i.alias("pos"), v.alias("value"))),
                         lambda x: x["value"] != 0)
        return out.select("crash_id", F.explode(slots).alias("slot")).select(
            "crash_id", F.col("slot.pos").cast("int").alias("pos"), F.col("slot.value").alias("value"))

    run.__doc__ = (f"M1-M6/M10, recipe {recipe.name}: its feature stages fitted on the training part; the feature "
                   "vector of every test row, " + ("one column per element." if dense else "as non-zero entries."))
    return run


for _recipe in recipes.RECIPES.values():
    register(f"recipe_features_{_recipe.name}",
             _indexed_sql(_recipe) if _recipe.encode == "index" else _one_hot_sql(_recipe))(_features_query(_recipe))


_R3 = recipes.RECIPES["3"]


@register("recipe_labels_3", _recipe_sql(
    _R3, ["main_reason"], "SELECT te.crash_id, te.main_reason,"
    " coalesce(r_main_reason.main_reason_idx, CAST((SELECT count(*) FROM r_main_reason) AS DOUBLE)) AS label"
    " FROM te LEFT JOIN r_main_reason ON te.main_reason = r_main_reason.main_reason_value"))
def recipe_labels_3(spark, sf_dir):
    """M1/C4/M10, recipe 3: the main factor (first non-null factor) indexed
    in keep mode on the training part; label index of every test row."""
    out = _recipe_features(spark, sf_dir, "3")
    return out.select("crash_id", "main_reason", "label")


# --- models ----------------------------------------------------------------

def fitted(spark, sf_dir, name):
    """A recipe's run: fitted for the first query that asks, then loaded."""
    source = raw(spark, sf_dir)
    return recipes.stored_run(cleaning.clean_crashes(source), name, source)


def _model_query(name):
    def run(spark, sf_dir):
        return fitted(spark, sf_dir, name).metrics()
    run.__doc__ = f"M7-M11/M12, recipe {name}: fit on the training part, metrics on the test part."
    return run


for _name in recipes.RECIPES:
    register(f"model_{_name}")(_model_query(_name))


# What a fit must show whatever its trees: every test row scored once, and
# more learned than a constant answer gives (the share of the most frequent
# training label; the mean, whose R2 is at most 0).

def _check_query(recipe):
    def run(spark, sf_dir):
        scored = fitted(spark, sf_dir, recipe.name).scored
        if recipe.task == "classify":
            right = (F.col("prediction") == F.col("label")).cast("double")
            constant = (F.col("label") == 0).cast("double")  # index 0: the most frequent in training
            better = F.avg(right) > F.avg(constant)
        else:
            y = F.col(recipe.label).cast("double")
            better = F.sum((y - F.col("prediction")) ** 2) < F.var_pop(y) * F.count(F.lit(1))
        return scored.agg(F.lit(recipe.name).alias("model"), F.count(F.lit(1)).alias("n_scored"),
                          F.count_distinct("crash_id").alias("n_ids"), better.alias("better_than_constant"))
    run.__doc__ = f"M7-M9, recipe {recipe.name}: rows scored, and whether the fit beats a constant answer."
    return run


#: recipes whose label follows their inputs in the crash fixture
_LEARNABLE = ("1a", "1b", "2a", "2b", "3", "4", "5")

for _recipe in (recipes.RECIPES[_n] for _n in _LEARNABLE):
    register(f"model_check_{_recipe.name}", "WITH " + O.CLEAN_CTE + _input_sql(_recipe) + (
        f" SELECT '{_recipe.name}' AS model, count(*) AS n_scored, count(DISTINCT crash_id) AS n_ids, "
        "TRUE AS better_than_constant FROM te"))(_check_query(_recipe))


def _pairs_sql(recipe):
    return ("WITH " + O.CLEAN_CTE + _input_sql(recipe) + f" SELECT crash_id, {recipe.label} FROM te "
            f"ORDER BY crash_id, {recipe.label} LIMIT 10")


def _pairs(spark, sf_dir, name):
    """Actual and predicted label of the first ten test crashes. The rows are
    picked from the test part first (a top-k) and only they are scored: the
    order does not depend on the prediction."""
    recipe = recipes.RECIPES[name]
    run = fitted(spark, sf_dir, name)
    first = delimited.preview(run.test, 10, order_by=["crash_id", recipe.label])
    return models.prediction_pairs(run.model.transform(first), recipe.label, run.label_list(), n=10,
                                   order_by=["crash_id", recipe.label], keep=["crash_id"])


def _pairs_query(name):
    def run(spark, sf_dir):
        return _pairs(spark, sf_dir, name)
    run.__doc__ = f"M15, recipe {name}: actual vs predicted label for the first ten test crashes."
    return run


for _name in ("1a", "1b", "2a", "2b"):
    register(f"prediction_pairs_{_name}")(_pairs_query(_name))
register("prediction_pairs")(_pairs_query("3"))


@register("prediction_pair_keys", _pairs_sql(recipes.RECIPES["2a"]))
def prediction_pair_keys(spark, sf_dir):
    """The crashes and true labels of recipe 2a's pairs."""
    return _pairs(spark, sf_dir, "2a").select("crash_id", recipes.RECIPES["2a"].label)


@register("feature_importance")
def feature_importance(spark, sf_dir):
    """Importances of the recipe-5 tree, named from vector metadata."""
    run = fitted(spark, sf_dir, "5")
    return models.feature_importance(spark, run.model, run.scored)


_R5 = recipes.RECIPES["5"]


@register("importance_slots", _recipe_sql(_R5, list(_R5.categorical), " UNION ALL ".join(
    [f"SELECT '{col}' AS feature, CAST(1 AS DOUBLE) AS total" for col in _R5.numeric]
    + [f"SELECT '{col}_ohe_' || {col}_value AS feature, CAST(1 AS DOUBLE) AS total FROM r_{col} "
       f"WHERE {col}_idx < (SELECT count(*) FROM r_{col}) - 1" for col in _R5.categorical])))
def importance_slots(spark, sf_dir):
    """The names of all slots and the sum of their importances."""
    found = feature_importance(spark, sf_dir)
    total = found.agg(F.round(F.sum("importance"), 9).alias("total"))
    return found.select("feature").crossJoin(F.broadcast(total))  # one row


_STUMP = "month"


@register("tree_stump", O.with_clean(
    f", v AS (SELECT CAST({_STUMP} AS DOUBLE) AS x, CAST(total_cars AS DOUBLE) AS y FROM clean)"
    ", u AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx FROM (SELECT DISTINCT x FROM v))"
    ", t AS (SELECT (x + nx) / 2 AS threshold FROM u WHERE nx IS NOT NULL)"
    ", g AS (SELECT threshold, avg(y) FILTER (x <= threshold) AS left_mean, avg(y) FILTER (x > threshold) AS right_mean,"
    " sum(y) FILTER (x <= threshold) AS sl, count(*) FILTER (x <= threshold) AS nl,"
    " sum(y) FILTER (x > threshold) AS sr, count(*) FILTER (x > threshold) AS nr FROM t CROSS JOIN v GROUP BY 1)"
    ", best AS (SELECT * FROM g ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1)"
    " SELECT threshold, round(left_mean, 9) AS left_mean, round(right_mean, 9) AS right_mean,"
    " round((SELECT sqrt(avg((y - CASE WHEN x <= threshold THEN left_mean ELSE right_mean END) ** 2)) FROM v), 9) AS rmse"
    " FROM best"))
def tree_stump(spark, sf_dir):
    """M9: a regression tree of depth one, vehicle count by month: its split,
    its two leaves and its error."""
    rows = clean(spark, sf_dir).select("crash_id", _STUMP, "total_cars")
    model = models.train([features.assemble([_STUMP]), models.tree_regressor("total_cars", max_depth=1, max_bins=32)],
                         rows, "crash_id")
    scored = models.score(model, rows)
    split = model.stages[-1]._java_obj.rootNode().split().threshold()
    error = F.avg((F.col("total_cars") - F.col("prediction")) ** 2)
    left = F.max(F.when(F.col(_STUMP) <= split, F.col("prediction")))
    right = F.max(F.when(F.col(_STUMP) > split, F.col("prediction")))
    return scored.agg(F.lit(split).alias("threshold"), F.round(left, 9).alias("left_mean"),
                      F.round(right, 9).alias("right_mean"), F.round(F.sqrt(error), 9).alias("rmse"))


# --- learners by value -----------------------------------------------------------
# Forests without bagging or feature draws have one answer, so SQL can grow
# their trees anew (oracle.tree_ctes) and every value of theirs is compared.

_FLAT = ["zip_code", "month", "total_cars"]
_FLAT_DEPTH = 2
_FLAT_PARAMS = {"bootstrap": False, "featureSubsetStrategy": "all", "maxBins": 512}
_CLASS_SQL = O.with_clean(", r AS (" + O.frequency_rank_sql("time_segment", "clean", "time_segment") + "), "
                          "src AS MATERIALIZED (SELECT row_number() OVER () AS id, clean.*, time_segment_idx AS y FROM clean "
                          "JOIN r ON time_segment = time_segment_value), ")
_NUMBER_SQL = O.with_clean(", src AS MATERIALIZED (SELECT row_number() OVER () AS id, *, CAST(total_injured AS DOUBLE) AS y FROM clean), ")
_CLASS_TREE = _CLASS_SQL + O.tree_ctes("tree", "src", _FLAT, True, _FLAT_DEPTH)
_NUMBER_TREE = _NUMBER_SQL + O.tree_ctes("tree", "src", _FLAT, False, _FLAT_DEPTH)


def _flat_stages(classify, trees=1):
    learner = (models.forest_classifier("label", num_trees=trees, max_depth=_FLAT_DEPTH, **_FLAT_PARAMS) if classify else
               models.forest_regressor("total_injured", num_trees=trees, max_depth=_FLAT_DEPTH,
                                       **{k: v for k, v in _FLAT_PARAMS.items() if k != "maxBins"}, max_bins=_FLAT_PARAMS["maxBins"]))
    label = [features.index_categories(["time_segment"], ["label"], invalid="error")] if classify else []
    return [features.assemble(_FLAT), *label, learner]


def _flat_fit(spark, sf_dir, classify, trees=1):
    """Model, where it is stored, and the clean rows with its answers; one fit
    per input, as for the recipes."""
    source = raw(spark, sf_dir)
    rows = cleaning.clean_crashes(source)
    stage_list = _flat_stages(classify, trees)
    key = model_store.fingerprint("flat", classify, trees, _FLAT, _FLAT_DEPTH, _FLAT_PARAMS, model_store.source_fingerprint(source))
    folder = model_store.find(spark, key)
    if folder is None:
        attempt = model_store.new_folder(spark, key)
        models.train(stage_list, rows, "crash_id").write().save(f"{attempt}/model")
        folder = model_store.finish(spark, key, attempt)
    model = PipelineModel.load(f"{folder}/model")
    return model, f"{folder}/model", models.score(model, rows)


def _node_paths(nodes, depth):
    """Every node of a small tree with its path of L and R from the root."""
    level = nodes.where("node = 0").withColumn("path", F.lit(""))
    every = level
    for _ in range(depth):
        below = level.where("left IS NOT NULL").select("path", "left", "right")
        steps = below.select(F.explode(F.array(F.struct(F.col("left").alias("node"), F.concat("path", F.lit("L")).alias("path")),
                                               F.struct(F.col("right").alias("node"), F.concat("path", F.lit("R")).alias("path")))
                                       ).alias("s")).select("s.*")
        level = nodes.join(steps, "node")
        every = every.unionByName(level)
    return every


def _flat_nodes(spark, sf_dir, classify, trees=1):
    model, path, scored = _flat_fit(spark, sf_dir, classify, trees)
    nodes = _node_paths(model_store.node_table(spark, path, model).where("tree = 0"), _FLAT_DEPTH)
    name = F.element_at(F.array(*[F.lit(x) for x in _FLAT]), F.col("feature") + 1)
    return model, path, scored, nodes.select("path", F.when(F.col("feature").isNotNull(), name).alias("feature"), "threshold",
                                             F.round(F.col("gain") * F.col("weight"), 6).alias("gain"), "rows", "prediction")


_NODE_SQL = "SELECT path, feature, threshold, round(gain, 6) AS gain, rows, {value} FROM tree_nodes"


@register("gini_tree", _CLASS_TREE + " " + _NODE_SQL.replace("{value}", "time_segment_value AS answer")
          + " JOIN r ON r.time_segment_idx = value")
def gini_tree(spark, sf_dir):
    """M7: every node of a classification tree: split, gain, rows and answer."""
    model, _, _, nodes = _flat_nodes(spark, sf_dir, classify=True)
    labels = F.array(*[F.lit(x) for x in model.stages[1].labelsArray[0]])
    return nodes.withColumn("answer", F.element_at(labels, F.col("prediction").cast("int") + 1)).drop("prediction")


@register("gini_tree_accuracy", _CLASS_TREE + " SELECT 'accuracy' AS metric, round(avg(CASE WHEN n.value = s.y THEN 1.0 ELSE 0.0 END), 9) "
          "AS value FROM src s JOIN tree_rows t ON t.id = s.id JOIN tree_nodes n ON n.path = t.path")
def gini_tree_accuracy(spark, sf_dir):
    """Accuracy of that tree on its rows."""
    return evaluate.classification_metrics(_flat_fit(spark, sf_dir, classify=True)[2], digits=9)


@register("gini_tree_importance", _CLASS_TREE + ", f AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in _FLAT) + "]) AS feature) "
          "SELECT f.feature, round(coalesce(sum(n.gain), 0) / (SELECT sum(gain) FROM tree_nodes), 9) AS importance "
          "FROM f LEFT JOIN tree_nodes n ON n.feature = f.feature GROUP BY 1")
def gini_tree_importance(spark, sf_dir):
    """Importances summed from the node table by SQL."""
    model, path, _ = _flat_fit(spark, sf_dir, classify=True)
    found = model_store.importance_from_nodes(model_store.node_table(spark, path, model), _FLAT)
    return found.withColumn("importance", F.round("importance", 9))


@register("gini_tree_pairs", _CLASS_TREE + " SELECT s.crash_id, s.time_segment, r.time_segment_value AS predicted FROM src s "
          "JOIN tree_rows t ON t.id = s.id JOIN tree_nodes n ON n.path = t.path JOIN r ON r.time_segment_idx = n.value "
          f"ORDER BY s.crash_id, s.time_segment, predicted, {', '.join('s.' + x for x in _FLAT)} LIMIT 10")
def gini_tree_pairs(spark, sf_dir):
    """Actual and predicted segment of the first ten crashes, the tree
    followed through its node table."""
    model, path, scored = _flat_fit(spark, sf_dir, classify=True)
    nodes = model_store.node_table(spark, path, model)
    rows = model_store.score_with_nodes(scored, nodes, _FLAT_DEPTH, classify=True, out="node_answer")
    labels = F.array(*[F.lit(x) for x in model.stages[1].labelsArray[0]])
    rows = rows.withColumn("predicted", F.element_at(labels, F.col("node_answer").cast("int") + 1))
    ordered = rows.select("crash_id", "time_segment", "predicted", *_FLAT)
    return delimited.preview(ordered, 10, ["crash_id", "time_segment", "predicted", *_FLAT]).select(
        "crash_id", "time_segment", "predicted")


@register("mean_forest", _NUMBER_TREE + " " + _NODE_SQL.replace("{value}", "round(value, 9) AS answer"))
def mean_forest(spark, sf_dir):
    """M8: every node of the first tree of a regression forest without bagging."""
    nodes = _flat_nodes(spark, sf_dir, classify=False, trees=3)[3]
    return nodes.withColumn("answer", F.round("prediction", 9)).drop("prediction")


@register("mean_forest_error", _NUMBER_TREE + ", e AS (SELECT s.y, n.value AS p FROM src s JOIN tree_rows t ON t.id = s.id "
          "JOIN tree_nodes n ON n.path = t.path) SELECT count(*) AS n_rows, round(sqrt(avg((y - p) * (y - p))), 9) AS rmse, "
          "round(sqrt(avg((y - p) * (y - p))), 9) AS rmse_from_nodes FROM e")
def mean_forest_error(spark, sf_dir):
    """The forest's error, and that of its trees' leaves averaged by SQL."""
    model, path, scored = _flat_fit(spark, sf_dir, classify=False, trees=3)
    rows = model_store.score_with_nodes(scored, model_store.node_table(spark, path, model), _FLAT_DEPTH, classify=False)
    error = lambda p: F.round(F.sqrt(F.avg((F.col("total_injured") - F.col(p)) ** 2)), 9)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), error("prediction").alias("rmse"),
                    error("node_prediction").alias("rmse_from_nodes"))


def _nodes_agree_query(recipe):
    def run(spark, sf_dir):
        run_ = fitted(spark, sf_dir, recipe.name)
        nodes = run_.nodes()
        classify = recipe.task == "classify"
        depth = run_.model.stages[-1].getMaxDepth()
        rows = model_store.score_with_nodes(run_.scored, nodes, depth, classify)
        names = models.slot_names(run_.scored, run_.model.stages[-1].numFeatures)
        shares = model_store.importance_from_nodes(nodes, names).withColumnRenamed("importance", "share")
        frame = models.feature_importance(spark, run_.model, run_.scored)
        off = frame.join(shares, "feature", "full").agg(F.count_if(
            F.coalesce(F.abs(F.col("importance") - F.col("share")) > 1e-9, F.lit(True))).alias("importances_off"))
        close = F.abs(F.col("prediction") - F.col("node_prediction")) <= 1e-9
        return rows.agg(F.lit(recipe.name).alias("model"), F.count(F.lit(1)).alias("n_scored"),
                        F.count_if(~close).alias("predictions_off")).crossJoin(F.broadcast(off))  # one row each
    run.__doc__ = f"M7-M9/M13/M15, recipe {recipe.name}: its predictions and importances against its node table, by SQL."
    return run


for _recipe in (recipes.RECIPES[_n] for _n in ("1a", "2b", "4", "5")):
    register(f"nodes_agree_{_recipe.name}", "WITH " + O.CLEAN_CTE + _input_sql(_recipe) + (
        f" SELECT '{_recipe.name}' AS model, count(*) AS n_scored, 0 AS predictions_off, 0 AS importances_off FROM te"))(
        _nodes_agree_query(_recipe))


# A search whose fits have one answer: folds by md5, two depths, SQL grows the
# tree of every fold and depth.
_SEARCH_FOLDS, _SEARCH_DEPTHS = 2, (1, 2)


def _search_sql():
    fold = O.split_bucket_sql("crash_id", "fold-42", _SEARCH_FOLDS)
    parts, scored = [f"src2 AS MATERIALIZED (SELECT *, {fold} AS fold FROM src)"], []
    for f in range(_SEARCH_FOLDS):
        # class order is that of the training folds
        parts.append(f"rk{f} AS MATERIALIZED (" + O.frequency_rank_sql("time_segment", f"(SELECT * FROM src2 WHERE fold <> {f})", "seg") + ")")
        parts.append(f"fs{f} AS MATERIALIZED (SELECT src2.* EXCLUDE (y), seg_idx AS y FROM src2 JOIN rk{f} ON time_segment = seg_value "
                     f"WHERE fold <> {f})")
        for d in _SEARCH_DEPTHS:
            n = f"f{f}d{d}"
            parts.append(O.tree_ctes(n, f"fs{f}", _FLAT, True, d))
            at = "''"
            for _ in range(d):  # follow the held rows down the kept splits
                at = (f"(SELECT coalesce(max({{p}} || CASE WHEN CASE k.f WHEN 0 THEN s.{_FLAT[0]} WHEN 1 THEN s.{_FLAT[1]} ELSE s.{_FLAT[2]} END "
                      f"<= k.t THEN 'L' ELSE 'R' END), {{p}}) FROM {n}_kept k WHERE k.path = {{p}})").replace("{p}", at)
            scored.append(f"SELECT {d} AS depth, {f} AS fold, avg(CASE WHEN n.value = rk.seg_idx THEN 1.0 ELSE 0.0 END) AS value FROM "
                          f"(SELECT s.*, {at} AS leaf FROM src2 s WHERE fold = {f}) h JOIN {n}_nodes n ON n.path = h.leaf "
                          f"JOIN rk{f} rk ON rk.seg_value = h.time_segment")
    return (_CLASS_SQL + ", ".join(parts) + ", scores AS (" + " UNION ALL ".join(scored) + ") "
            "SELECT 'maxDepth=' || depth AS params, 'accuracy' AS metric, round(avg(value), 9) AS value FROM scores GROUP BY depth")


@register("search_by_value", _search_sql())
def search_by_value(spark, sf_dir):
    """A grid of two depths over two folds, the averages by value."""
    rows = clean(spark, sf_dir).select("crash_id", "time_segment", *_FLAT)
    table, _ = models.cross_validate(_flat_stages(True), rows, {"maxDepth": list(_SEARCH_DEPTHS)}, "crash_id",
                                     folds=_SEARCH_FOLDS, seed=42)
    return table.withColumn("value", F.round("value", 9))


_GRID = {"numTrees": [3, 5], "maxDepth": [2, 3]}


def _cross_validated(spark, sf_dir, name):
    recipe = recipes.RECIPES[name]
    stored = models.materialize(recipes.model_input(clean(spark, sf_dir), recipe), f"cv-input-{name}")
    train_df, test_df = recipes.split(stored, recipe)
    stage_list, label_col = recipes.stages(recipe)
    table, best = models.cross_validate(stage_list, train_df, _GRID, recipes.KEY, label=label_col,
                                        metric="accuracy", folds=5, seed=42)
    return table, best, models.score(best, test_df), recipe


def _grid_query(name):
    def run(spark, sf_dir):
        return _cross_validated(spark, sf_dir, name)[0]
    run.__doc__ = f"M14: 5-fold cross-validation of recipe {name} over trees {{3, 5}} x depth {{2, 3}}."
    return run


register("cross_validate")(_grid_query("1a"))
register("cross_validate_2a")(_grid_query("2a"))


@register("best_model", "WITH " + O.CLEAN_CTE + _input_sql(recipes.RECIPES["2a"]) +
          " SELECT count(*) AS n_scored, TRUE AS better_than_constant, 4 AS grid_points, 8 AS features, CAST(1 AS DOUBLE) AS importance FROM te")
def best_model(spark, sf_dir):
    """Recipe 2a's best grid point, fitted on the whole training part
    and scored on the test part, and its forest's importances."""
    table, best, scored, _ = _cross_validated(spark, sf_dir, "2a")
    found = models.feature_importance(spark, best, scored).agg(
        F.count(F.lit(1)).cast("int").alias("features"), F.round(F.sum("importance"), 9).alias("importance"))
    points = table.agg(F.count(F.lit(1)).cast("int").alias("grid_points"))
    out = scored.agg(F.count(F.lit(1)).alias("n_scored"), (
        F.avg((F.col("prediction") == F.col("label")).cast("double")) > F.avg((F.col("label") == 0).cast("double"))
    ).alias("better_than_constant"))
    return out.crossJoin(points).crossJoin(found)  # one row each
