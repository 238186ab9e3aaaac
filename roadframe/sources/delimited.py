"""Delimited-file source and sink, session views, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.functions.columns import c
from roadframe.schema import raw_schema
from roadframe.session import fresh_shared_path


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   infer: bool = False, header: bool = True, sep: str = ",",
                   sampling_ratio: float = 1.0) -> DataFrame:
    """Read a delimited file with a header row.

    By default the raw crash layout is applied as an explicit all-string schema,
    so the scan is a single pass with no inference job; header names must
    match the schema. ``infer=True`` runs
    Spark's type inference instead (an extra pass over the input); date and time
    text is then kept as text by pinning parse formats that plain ``H:mm`` times
    and ``MM/dd/yyyy`` dates do not match, so later steps still see strings.
    """
    reader = (
        spark.read.option("header", str(header).lower())
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
    )
    if infer and schema is not None:
        raise ValueError("pass either an explicit schema or infer=True, not both")
    if infer:
        reader = (
            reader.option("inferSchema", "true")
            .option("enforceSchema", "false")  # still check every file's header
            .option("samplingRatio", str(sampling_ratio))
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
            .option("dateFormat", "yyyy-MM-dd")
            .option("preferDate", "false")
        )
    else:
        # with a header row, Spark checks each file's header against the
        # schema's names, so a file with another column order fails loudly
        # instead of being read by position into the wrong columns
        reader = reader.schema(schema or raw_schema()).option("enforceSchema", str(not header).lower())
    return reader.csv(path)


def read_delimited_checked(spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True,
                           sep: str = ",", multi_line: bool = False,
                           work_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``: the rows that have every field of the schema, and
    the text of those with too few or too many fields or an open quote, as
    ``(record, file)``. A plain read pads and cuts such rows in silence.

    The text is parsed once, into a stored table (at ``work_path``, or a new
    scratch folder) that both frames read. ``multi_line`` lets a quoted field
    hold line breaks; a file is then read by one task, and an open quote runs
    on to the next quote. Without it such a field breaks into rejected rows.
    """
    schema = schema or raw_schema()
    corrupt = "_record"
    reader = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]))
        .option("header", str(header).lower())
        .option("enforceSchema", str(not header).lower())
        .option("sep", sep)
        .option("escape", '"')  # a quote inside a quoted field is doubled
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .option("multiLine", str(multi_line).lower())
    )
    parsed = reader.csv(path)
    parsed = parsed.select(*[c(name) for name in parsed.columns], F.col("_metadata.file_path").alias("_file"))
    store = work_path or fresh_shared_path(spark, "parsed")
    parsed.write.mode("overwrite").parquet(store)
    stored = spark.read.schema(parsed.schema).parquet(store)
    kept = stored.where(F.col(corrupt).isNull()).drop(corrupt, "_file")
    rejected = stored.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("record"), F.col("_file").alias("file"))
    return kept, rejected


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists",
                    max_records: int = 0) -> str:
    """Write a frame as delimited text with a header row.

    Leading and trailing blanks are kept (Spark trims them by default when
    writing), so a field of blanks reads back as the same blanks. An empty
    string and a null both read back as null, and values with line breaks
    are not supported (multi-line records would make the file unsplittable).
    """
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", max_records)  # 0: no bound
        .csv(path)
    )
    return path


def land_as_parquet(spark: SparkSession, csv_path: str, out_path: str,
                    schema: T.StructType | None = None, partition_by: Sequence[str] | None = None,
                    mode: str = "errorifexists", infer: bool = False) -> DataFrame:
    """Land a delimited file as Parquet once, for repeated scans: columnar
    reads, column pruning and filter pushdown instead of re-parsing text.
    The text is read with the explicit schema (no inference pass) unless
    ``infer``; one Parquet file per input split, optionally partitioned."""
    frame = read_delimited(spark, csv_path, schema=schema, infer=infer)  # inference reads the text once
    writer = frame.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out_path)
    # read back with the written schema: no retyping of partition columns
    return spark.read.schema(frame.schema).parquet(out_path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a session view (replacing one of the same name) and
    return the frame read back through the catalog."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table("`" + name.replace("`", "``") + "`")


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows as a frame. With ``order_by`` the rows are the top ``n``
    by those columns (a top-k: each task keeps only its best ``n``), so the
    result is reproducible; without it any ``n`` rows may come back."""
    if order_by:
        df = df.orderBy(*[c(col) for col in order_by])
    return df.limit(n)
