"""Run the whole crash workflow on a crash CSV.

    python -m roadframe --csv /data/crashes.csv --out /shared/results \
        [--recipes 1a,1b,2a,2b,3,4,5] [--land /shared/raw_parquet] [--infer] \
        [--reject-bad-rows [--multi-line]] [--fit-partitions N]

Steps: read the CSV once (explicit all-string schema, or inference) and
land it as Parquet, register the raw view, profile (distinct counts,
distinct factor values), clean, count, then fit and score each recipe.
Every result is a DataFrame written as Parquet under ``--out``:
``profile_counts``, ``factor_values``, ``clean_rows``, ``metrics``,
``predictions_<recipe>`` (every test row, scored once), ``pairs_<recipe>``
and, unless ``--no-clean-table``, ``clean`` (the clean table itself) and
``removed`` (rows removed by reason, counted while it is written). With
``--reject-bad-rows`` rows with too few or too many fields go to ``rejected``
as text; otherwise they are padded or cut.
Nothing is collected to the driver except a short summary printed at the
end.
"""

from __future__ import annotations

import argparse
import functools

from roadframe import schema as S
from roadframe.operators import models, profile
from roadframe.plans import recipes
from roadframe.plans.cleaning import clean_crashes, clean_crashes_counted, removal_rows
from roadframe.session import build_session
from roadframe.sources import delimited


def run(spark, csv_path: str, out: str, recipe_names: list[str], land: str | None = None,
        infer: bool = False, write_clean: bool = True, reject_bad_rows: bool = False, multi_line: bool = False,
        partitions: int | None = None) -> dict[str, str]:
    """Run the workflow; returns the written result paths by name.

    The CSV text is parsed once: it is landed as Parquet (at ``land``, or
    ``<out>/_work/raw``) and every later step scans that table. Each
    recipe's model input goes to ``<out>/_work/input_<recipe>`` and is
    overwritten by the next run, so repeated runs do not pile up copies."""
    work = f"{out.rstrip('/')}/_work"
    # the default landing folder is ours to overwrite; a user-named one must be new
    mode = "errorifexists" if land else "overwrite"
    land = land or f"{work}/raw"
    rejected = None
    if reject_bad_rows:
        kept, rejected = delimited.read_delimited_checked(spark, csv_path, multi_line=multi_line, work_path=f"{work}/parsed")
        kept.write.mode(mode).parquet(land)
        landed = spark.read.schema(kept.schema).parquet(land)
    else:
        landed = delimited.land_as_parquet(spark, csv_path, land, mode=mode, infer=infer)
    raw = delimited.register_view(landed, "crashes_raw")
    written = {"raw": land}

    def save(name, df):
        path = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        written[name] = path

    save("profile_counts", profile.distinct_counts(
        raw, [S.CRASH_TIME, S.FACTOR_COLUMNS[0]],
        aliases={S.CRASH_TIME: "distinct_crash_time", S.FACTOR_COLUMNS[0]: "distinct_factor_v1"}))
    save("factor_values", profile.distinct_values_across(raw, S.FACTOR_COLUMNS))
    if rejected is not None:
        save("rejected", rejected)
    clean = clean_crashes(raw)
    if write_clean:
        counted, counts = clean_crashes_counted(raw)
        save("clean", counted)
        save("removed", removal_rows(spark, counts))
        clean = spark.read.parquet(written["clean"])  # later steps scan the written table
    save("clean_rows", profile.row_count(clean))
    metric_frames = []
    for name in recipe_names:
        result = recipes.run_recipe(clean, name, work_path=f"{work}/input_{name}", partitions=partitions)
        # score the test part once; metrics and pairs read the written predictions
        save(f"predictions_{name}", result.predictions())
        scored = spark.read.parquet(written[f"predictions_{name}"])
        metric_frames.append(recipes.recipe_metrics(result.recipe, scored, result.label_col))
        save(f"pairs_{name}", models.prediction_pairs(scored, result.recipe.label, result.label_list(), n=10,
                                                      order_by=[recipes.KEY], keep=[recipes.KEY]))
    if metric_frames:
        save("metrics", functools.reduce(lambda a, b: a.unionByName(b), metric_frames))
    return written


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m roadframe", description=__doc__.split("\n\n")[0])
    parser.add_argument("--csv", required=True, help="crash CSV file or folder (header row)")
    parser.add_argument("--out", required=True, help="folder for the result tables")
    parser.add_argument("--recipes", default=",".join(recipes.RECIPES),
                        help="comma-separated recipe names (default: all)")
    parser.add_argument("--land", default=None,
                        help="new folder to land the CSV as Parquet (default: <out>/_work/raw)")
    parser.add_argument("--infer", action="store_true", help="infer column types instead of the schema")
    parser.add_argument("--no-clean-table", action="store_true", help="do not write the clean table")
    parser.add_argument("--reject-bad-rows", action="store_true", help="put rows with too few or too many fields aside")
    parser.add_argument("--multi-line", action="store_true", help="with --reject-bad-rows: quoted fields may hold line breaks")
    parser.add_argument("--fit-partitions", type=int,
                        help="partitions that a learner's rows are dealt to (decides the bagging; default: by their number)")
    parser.add_argument("--master", default=None, help="Spark master for a local run, e.g. local[8]")
    args = parser.parse_args(argv)
    names = [n.strip() for n in args.recipes.split(",") if n.strip()]
    unknown = [n for n in names if n not in recipes.RECIPES]
    if unknown:
        parser.error(f"unknown recipes {unknown}; choose from {list(recipes.RECIPES)}")
    if (args.multi_line or args.reject_bad_rows) and (args.infer or not args.reject_bad_rows):
        parser.error("--multi-line needs --reject-bad-rows, which reads with the explicit schema")
    if args.master:
        spark = build_session(master=args.master, extra={"spark.checkpoint.dir": f"{args.out.rstrip('/')}/_work/checkpoints"})
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName("roadframe").getOrCreate()
    written = run(spark, args.csv, args.out, names, land=args.land, infer=args.infer,
                  write_clean=not args.no_clean_table, reject_bad_rows=args.reject_bad_rows, multi_line=args.multi_line,
                  partitions=args.fit_partitions)
    if "metrics" in written:
        spark.read.parquet(written["metrics"]).show(truncate=False)
    print({k: v for k, v in written.items()})


if __name__ == "__main__":
    main()
