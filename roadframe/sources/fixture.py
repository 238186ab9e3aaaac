"""Crash-shaped test input projected from the ``orders`` table.

The provided tables hold no crash file, so a raw 29-column crash frame is
projected from ``orders`` with integer arithmetic (no random functions). The
projection only shapes rows in the raw schema; every cleaning and modelling
step then runs on it through the library's own code. It includes nulls,
missing and impossible dates, missing and unreadable times, blank, lettered
and decimal zips and counts, unlisted factors, vehicle-count gaps, crash ids
that repeat as exact copies (2%) and with other values (2%), and one id on 4%
of the rows. Hour and first factor follow borough and month in most rows, so
a model can learn more than the most frequent label.

The same SQL text runs in Spark and in DuckDB; only the identifier quote
differs (backtick vs double quote).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.session import checkpoint_dir, compiled_methods, fresh_shared_path, path_exists
from roadframe.sources.delimited import read_delimited, write_delimited
from roadframe.sources.tables import load_table

#: records in a landed file
FILE_RECORDS = 20_000

_FIXTURE_TEMPLATE = """
WITH b AS (
  SELECT o_orderkey AS k, (o_orderkey * 7919 + o_custkey * 104729) % 1000003 AS h, o_orderdate AS d FROM {orders}
), b2 AS (
  SELECT k, h, d FROM b UNION ALL SELECT k, (h + 13) % 1000003 AS h, d FROM b WHERE k % 50 = 25
), n AS (
  SELECT k, h, d,
    CASE WHEN h % 5 < 2 THEN (h % 29) % 24 ELSE ((h % 7) * 6 + 2 + CASE WHEN month(d) > 6 THEN 6 ELSE 0 END) % 24 END AS hr,
    CASE WHEN h % 3 = 0 THEN h % 12 ELSE (h % 7 + CASE WHEN month(d) > 6 THEN 4 ELSE 0 END) % 12 END AS f1,
    CASE WHEN h % 10 < 6 THEN 0 WHEN h % 10 < 9 THEN 1 ELSE 3 END AS mot_i,
    CASE WHEN h % 17 = 0 THEN 1 ELSE 0 END AS ped_i, CASE WHEN h % 19 = 0 THEN 1 ELSE 0 END AS cyc_i,
    CASE WHEN h % 101 = 0 THEN 1 ELSE 0 END AS mot_k, CASE WHEN h % 103 = 0 THEN 1 ELSE 0 END AS ped_k,
    CASE WHEN h % 211 = 0 THEN 1 ELSE 0 END AS cyc_k,
    CASE WHEN h % 20 < 5 THEN 1 WHEN h % 20 < 14 THEN 2 WHEN h % 20 < 17 THEN 3 WHEN h % 20 < 19 THEN 4 ELSE 5 END AS cars
  FROM b2
), r AS (
  SELECT
    CASE WHEN h % 97 = 0 THEN NULL WHEN h % 97 = 1 THEN '13/45/2021' WHEN h % 97 = 2 THEN 'unknown' WHEN h % 97 = 3 THEN '02/29/2021'
      ELSE lpad(cast(month(d) AS string), 2, '0') || '/' || lpad(cast(day(d) AS string), 2, '0') || '/' || cast(year(d) AS string) END AS {q}CRASH DATE{q},
    CASE WHEN h % 89 = 0 THEN NULL WHEN h % 89 = 1 THEN 'n/a' WHEN h % 89 = 2 THEN ':30'
      ELSE cast(hr AS string) || ':' || lpad(cast(h % 60 AS string), 2, '0') END AS {q}CRASH TIME{q},
    CASE h % 7 WHEN 0 THEN 'BROOKLYN' WHEN 1 THEN 'QUEENS' WHEN 2 THEN 'BROOKLYN' WHEN 3 THEN 'MANHATTAN' WHEN 4 THEN 'BRONX' WHEN 5 THEN 'STATEN ISLAND' END AS {q}BOROUGH{q},
    CASE WHEN h % 23 = 0 THEN NULL WHEN h % 23 = 1 THEN '     ' WHEN h % 46 = 2 THEN '1x201' WHEN h % 46 = 25 THEN cast(10000 + (h % 7) * 200 + h % 40 AS string) || '.0' ELSE cast(10000 + (h % 7) * 200 + h % 40 AS string) END AS {q}ZIP CODE{q},
    '40.' || lpad(cast(500 + h % 400 AS string), 3, '0') AS {q}LATITUDE{q}, '-73.' || lpad(cast(500 + h % 500 AS string), 3, '0') AS {q}LONGITUDE{q},
    cast(NULL AS string) AS {q}LOCATION{q}, 'STREET ' || cast(h % 300 AS string) AS {q}ON STREET NAME{q},
    cast(NULL AS string) AS {q}CROSS STREET NAME{q}, cast(NULL AS string) AS {q}OFF STREET NAME{q},
    CASE WHEN h % 499 = 0 THEN NULL WHEN h % 61 = 1 THEN cast(mot_i + ped_i + cyc_i AS string) || '.0' WHEN h % 61 = 2 THEN '2.5' WHEN h % 61 = 3 THEN 'two'
      ELSE cast(mot_i + ped_i + cyc_i AS string) END AS {q}NUMBER OF PERSONS INJURED{q},
    cast(mot_k + ped_k + cyc_k AS string) AS {q}NUMBER OF PERSONS KILLED{q},
    cast(ped_i AS string) AS {q}NUMBER OF PEDESTRIANS INJURED{q}, cast(ped_k AS string) AS {q}NUMBER OF PEDESTRIANS KILLED{q},
    cast(cyc_i AS string) AS {q}NUMBER OF CYCLIST INJURED{q}, cast(cyc_k AS string) AS {q}NUMBER OF CYCLIST KILLED{q},
    cast(mot_i AS string) AS {q}NUMBER OF MOTORIST INJURED{q}, cast(mot_k AS string) AS {q}NUMBER OF MOTORIST KILLED{q},
    CASE f1 WHEN 0 THEN 'Unspecified' WHEN 1 THEN 'Driver Inattention/Distraction' WHEN 2 THEN 'Following Too Closely' WHEN 3 THEN 'Illnes'
      WHEN 4 THEN 'Brakes Defective' WHEN 5 THEN 'Pavement Slippery' WHEN 6 THEN 'Cell Phone (hand-Held)' WHEN 7 THEN 'Unsafe Speed'
      WHEN 8 THEN 'Alcohol Involvement' WHEN 9 THEN '80' WHEN 10 THEN 'Not In Any Bucket' END AS {q}CONTRIBUTING FACTOR VEHICLE 1{q},
    CASE WHEN cars >= 2 THEN CASE h % 5 WHEN 0 THEN 'Unspecified' WHEN 1 THEN 'Glare' WHEN 2 THEN '1' WHEN 3 THEN 'Texting' END END AS {q}CONTRIBUTING FACTOR VEHICLE 2{q},
    CASE WHEN cars >= 3 THEN 'Tinted Windows' END AS {q}CONTRIBUTING FACTOR VEHICLE 3{q},
    CASE WHEN cars >= 4 THEN 'Unspecified' END AS {q}CONTRIBUTING FACTOR VEHICLE 4{q},
    CASE WHEN cars >= 5 THEN 'Fell Asleep' END AS {q}CONTRIBUTING FACTOR VEHICLE 5{q},
    cast(CASE WHEN h % 25 = 7 THEN 999999999 ELSE k END AS string) AS {q}COLLISION_ID{q},
    CASE WHEN h % 37 = 0 THEN NULL ELSE 'Sedan' END AS {q}VEHICLE TYPE CODE 1{q}, CASE WHEN cars >= 2 THEN 'Taxi' END AS {q}VEHICLE TYPE CODE 2{q},
    CASE WHEN cars >= 3 THEN 'Bus' END AS {q}VEHICLE TYPE CODE 3{q}, CASE WHEN cars >= 4 THEN 'Bike' END AS {q}VEHICLE TYPE CODE 4{q},
    CASE WHEN cars >= 5 THEN 'Van' END AS {q}VEHICLE TYPE CODE 5{q}, k AS _k
  FROM n
)
SELECT * FROM r UNION ALL SELECT * FROM r WHERE _k % 50 = 0
"""


def fixture_sql(dialect: str = "duckdb") -> str:
    """The fixture as SQL over a table named ``orders``; the result keeps the
    helper key ``_k`` (drop it to get the 29 raw columns)."""
    quote = {"duckdb": '"', "spark": "`"}[dialect]
    return _FIXTURE_TEMPLATE.replace("{q}", quote).replace("{orders}", "orders")


def crash_fixture(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Raw 29-column crash frame (all strings) projected from ``orders``. The
    projection uses the day only, so it is taken once, not in each expression."""
    text = _FIXTURE_TEMPLATE.replace("{q}", "`")
    used = orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return spark.sql(text, orders=used).drop("_k")


_LANDED: dict[tuple[str, str, str], str] = {}


def landed_fixture(spark: SparkSession, sf_dir: str, fmt: str = "parquet") -> DataFrame:
    """The crash fixture of ``sf_dir`` as stored files, read back.

    The projection is written once per session and format below the shared
    checkpoint folder, then every query scans the files: the same shape of
    work as a real job reading a landed crash file (plain column reads,
    pushdown, pruning), and the lineage to ``orders`` is cut.
    ``fmt`` is ``parquet`` or ``csv`` (header row, all-string schema).
    """

    key = (str(sf_dir).rstrip("/"), fmt, checkpoint_dir(spark))
    path = _LANDED.get(key)
    if path is None or not path_exists(spark, path):
        path = fresh_shared_path(spark, f"fixture-{fmt}")
        # written as the source is split, without a shuffle; small files, so
        # that the one file of a provided table does not make every later
        # crash query a single task
        raw = crash_fixture(spark, load_table(spark, sf_dir, "orders"))
        with compiled_methods(spark):
            if fmt == "parquet":
                raw.write.option("maxRecordsPerFile", FILE_RECORDS).parquet(path)
            elif fmt == "csv":
                write_delimited(raw, path, max_records=FILE_RECORDS)
            else:
                raise ValueError(f"unknown format {fmt!r}")
        _LANDED[key] = path
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_delimited(spark, path)


def landed_fixture_path(spark: SparkSession, sf_dir: str, fmt: str = "csv") -> str:
    """Path of the landed fixture files (writing them first if needed)."""
    landed_fixture(spark, sf_dir, fmt)
    return _LANDED[(str(sf_dir).rstrip("/"), fmt, checkpoint_dir(spark))]
