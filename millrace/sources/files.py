"""File sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH_IN_NAME = r"_(\d{4}-\d{2})"


def read_csv(spark, path, schema=None, limit=None, partitions=None, **options) -> DataFrame:
    """CSV with header; codec by suffix.  Give a schema: inference reads the files twice.

    A gzip file is one split, so ``partitions`` spreads its rows after the scan.
    """
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if partitions:
        df = df.repartition(partitions)
    return df.limit(limit) if limit is not None else df


def months_available(df, path_column=None, exclude=()) -> DataFrame:
    """Sorted months found in the file names behind ``df`` (or in a path column)."""
    path = F.col(path_column) if path_column else F.col("_metadata.file_path")
    month = F.regexp_extract(path, MONTH_IN_NAME, 1).alias("data_month")
    found = df.select(month).filter("data_month <> ''").distinct()
    return (found.filter(~F.col("data_month").isin(list(exclude))) if exclude else found).orderBy("data_month")


def read_months(spark, pattern, schema, corrupt="_corrupt_record") -> DataFrame:
    """All monthly files of one kind in one read; the month comes from the file name.

    Rows that do not parse stay in the ``corrupt`` column and do not fail the job.
    """
    columns = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema
    )
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .schema(f"{columns}, {corrupt} string")
        .csv(pattern)
        .withColumn("data_month", F.regexp_extract(F.col("_metadata.file_path"), MONTH_IN_NAME, 1))
    )


def load_months(spark, pattern, schema, path, max_bad=0.5, corrupt="_corrupt_record"):
    """All monthly files in one job: ``(rows, quarantine, report)``.

    The files are read once and written below ``path`` by month.  Rows that do
    not parse go to the quarantine with their line and month.  A month in which
    their share exceeds ``max_bad`` fails as a whole, the others go on; the
    report has ``data_month, n, n_bad, status`` for each month.
    """
    kept = read_months(spark, pattern, schema, corrupt)
    kept.write.mode("overwrite").partitionBy("data_month").parquet(path)
    kept = spark.read.schema(kept.schema).parquet(path)
    bad = F.col(corrupt).isNotNull()
    report = kept.groupBy("data_month").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad"))
    report = report.withColumn("status", F.when(F.col("n_bad") > max_bad * F.col("n"), "failed").otherwise("saved"))
    saved = report.filter("status = 'saved'").select("data_month")
    rows = kept.filter(~bad).join(saved, "data_month", "left_semi").drop(corrupt)
    return rows, kept.filter(bad).select("data_month", F.col(corrupt).alias("line")), report


def load_month(spark, root, month, schemas=None):
    """Calendar, listings and neighbourhoods of one month."""
    schemas = schemas or {}
    names = {
        "calendar": f"{root}/calendar_{month}.csv.gz",
        "listings": f"{root}/listings_{month}.csv.gz",
        "neighbourhoods": f"{root}/neighbourhoods_{month}.csv",
    }
    return tuple(read_csv(spark, path, schemas.get(kind), multiLine=False) for kind, path in names.items())


def run_months(months, work):
    """Apply ``work(month)`` to each month; a failing month is reported and the others go on."""
    report = []
    for month in months:
        try:
            work(month)
            report.append((month, "saved", ""))
        except Exception as error:  # noqa: BLE001 - isolation of months is the purpose
            report.append((month, "failed", str(error).splitlines()[0]))
    return report


def write_months(df, path, column="data_month", splits=32):
    """Parquet by month; only the months in ``df`` are replaced.

    A month is spread over up to ``splits`` tasks and files, so one month may
    hold most of the rows.
    """
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c != column]), F.lit(splits))
    (
        df.repartition(column, spread)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def consolidate(frames, reference_schema=None) -> DataFrame:
    """Union under the first frame's columns, order and types; missing columns are null."""
    frames = list(frames)
    schema = reference_schema or frames[0].schema

    def aligned(df):
        have = set(df.columns)
        return df.select(
            *[
                (F.col(f.name) if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
                for f in schema
            ]
        )

    return reduce(DataFrame.unionByName, [aligned(df) for df in frames])


def write_report_csv(df, path, decimals):
    """CSV report with rounded columns: ``decimals`` maps columns to digits."""
    df.withColumns({c: F.round(c, d) for c, d in decimals.items()}).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def write_jsonl(df, path):
    df.write.mode("overwrite").json(path)


def with_fallback(primary, fallback, key) -> DataFrame:
    """Primary rows, and fallback rows of keys the primary lacks."""
    missing = fallback.join(primary.select(key).distinct(), key, "left_anti")
    return primary.unionByName(missing)


def upsert_missing(existing, wanted_keys, compute, keys, defaults=None) -> DataFrame:
    """Keep stored rows, compute only wanted keys not stored, fill columns the store lacked."""
    missing = wanted_keys.join(existing.select(*keys), list(keys), "left_anti")
    merged = existing.unionByName(compute(missing), allowMissingColumns=True)
    return merged.withColumns(
        {c: F.coalesce(F.col(c), F.lit(value)) for c, value in (defaults or {}).items()}
    )
