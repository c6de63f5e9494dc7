"""File sources and sinks: CSV scan under a header contract, folder scan
through the registry, month folders, table profiles, month-partitioned
sinks.

Only metadata ever reaches the driver (a header line, a list of folder
names, bounded scalars). Rows stay in DataFrames.
"""

from __future__ import annotations

import csv
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.functions import exprs as X
from gridcube.functions.headers import normalize_names, number_duplicates
from gridcube.sources.registry import SOURCES, SourceSpec, header_matches

MONTH_RE = r"^\d{4}-\d{2}$"
SUPPORTED = (".csv",)
# Texts that stand for a missing number in exports.
MISSING = ("", "NA", "N/A", "n/a", "NaN", "nan", "NULL", "null", "None", "-nan", "-NaN", "#N/A", "<NA>")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The first line of a CSV file (or of the first part file of a CSV
    directory), parsed with CSV quoting rules. One small read."""
    first = spark.read.text(path).head()
    if first is None:
        return []
    return next(csv.reader([first.value]))


def read_strings(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Header (repeats numbered, blanks named) and all columns as strings.
    Spark checks every part file's header line against it while scanning;
    only where a header repeats a name are later parts taken by position."""
    header = read_header(spark, path)
    names = number_duplicates(header)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    df = (spark.read.schema(schema).option("header", True).option("enforceSchema", names != header)
          .option("mode", "FAILFAST").csv(path))
    return header, df


def typed(c: F.Column, kind: T.DataType) -> F.Column:
    """A text field as its contract's type; the usual tokens for a missing
    value are NULL, any other text that is no number is an error."""
    if isinstance(kind, T.StringType):
        return c
    return F.when(~X.strip(c).isin(*MISSING), X.strip(c)).cast(kind)


def scan_csv(spark: SparkSession, path: str, spec: SourceSpec, strict: bool = True,
             keep_extra: bool = True) -> DataFrame:
    """Read one monthly export with the canonical schema applied by
    position, after checking the file's header against the contract.

    Unsupported extensions raise ``ValueError``; a header that does not
    match the contract raises ``KeyError`` in strict mode, and otherwise the
    columns it lacks are NULL. Columns after the contract's (an export that
    gained a column) follow as strings under their normalised header unless
    ``keep_extra`` is off.
    """
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in SUPPORTED:
        raise ValueError(f"{path}: only {', '.join(SUPPORTED)} files can be scanned, not {ext or 'a file without extension'}")
    header, df = read_strings(spark, path)
    bad = [(exp, found) for exp, found, ok in header_matches(spec, header) if not ok]
    if bad and strict:
        raise KeyError(f"{spec.name}: header does not match contract: {bad}")
    schema, raw = spec.schema(), df.columns
    cols = [typed(F.col(_q(raw[i])) if i < len(raw) else F.lit(None).cast("string"), f.dataType).alias(f.name)
            for i, f in enumerate(schema)]
    if keep_extra:
        extra = [n for n in normalize_names(raw[len(schema):], spec.variant)]
        taken = [f"{n}_extra" if n in schema.names else n for n in extra]
        cols += [F.col(_q(r)).alias(n) for r, n in zip(raw[len(schema):], taken)]
    return df.select(*cols)


def scan_unknown(spark: SparkSession, path: str) -> DataFrame:
    """A CSV without a contract: every column as a string under its
    normalised header."""
    _, df = read_strings(spark, path)
    return df.toDF(*number_duplicates(normalize_names(df.columns)))


def schema_contract(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """(source, expected, found, present) per contract column."""
    rows = [(spec.name, exp, found, ok) for exp, found, ok in header_matches(spec, read_header(spark, path))]
    return spark.createDataFrame(rows, "source string, expected string, found string, present boolean")


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Raw header with repeated names numbered ``x``, ``x.1`` (as most
    spreadsheet readers label them)."""
    return number_duplicates(read_header(spark, path))


def _listdir(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder through Hadoop's FileSystem (works for any
    filesystem the cluster can read, not only local disks)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        raise FileNotFoundError(f"{folder} does not exist")
    return [s.getPath().getName() for s in fs.listStatus(p)]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def month_folders(spark: SparkSession, base: str) -> list[str]:
    """S3: sub-folders named ``YYYY-MM``."""
    return sorted(n for n in _listdir(spark, base) if re.match(MONTH_RE, n))


def latest_month_folder(spark: SparkSession, base: str) -> str:
    """S4 on folders: lexicographic max; none -> ``RuntimeError``."""
    months = month_folders(spark, base)
    if not months:
        raise RuntimeError(f"{base} has no folder named like a month (YYYY-MM)")
    return months[-1]


def resolve_files(spark: SparkSession, folder: str, month: str,
                  names: list[str] | None = None) -> dict[str, str | None]:
    """Case-insensitive resolution of each source's file for a month
    (the SNP file carries the next month's date). Missing -> None."""
    present = {n.lower(): n for n in _listdir(spark, folder)}
    out = {}
    for name in names or list(SOURCES):
        want = SOURCES[name].file_name(month).lower()
        hit = present.get(want)
        out[name] = os.path.join(folder, hit) if hit else None
    return out


def folder_report(spark: SparkSession, folder: str, month: str) -> DataFrame:
    """What a month folder holds against the registry: one row per registered
    source and per other CSV, (file, source, status, extra_columns). Status is
    ``loaded``, ``missing`` (no such file), ``unknown`` (a CSV no contract
    names) or ``mismatch`` (its header breaks the contract)."""
    rows, known = [], set()
    for name, path in resolve_files(spark, folder, month).items():
        if path is None:
            rows.append((SOURCES[name].file_name(month), name, "missing", 0))
            continue
        known.add(os.path.basename(path))
        header, spec = read_header(spark, path), SOURCES[name]
        ok = all(fine for _, _, fine in header_matches(spec, header))
        rows.append((os.path.basename(path), name, "loaded" if ok else "mismatch", max(0, len(header) - len(spec.columns))))
    for f in sorted(_listdir(spark, folder)):
        if f not in known and f.lower().endswith(SUPPORTED):
            rows.append((f, os.path.splitext(f)[0], "unknown", 0))
    return spark.createDataFrame(rows, "file string, source string, status string, extra_columns long")


def scan_folder(spark: SparkSession, folder: str, month: str,
                names: list[str] | None = None, with_metadata: bool = True) -> dict[str, DataFrame]:
    """S2 + S14: one lazy DataFrame per CSV of the folder, tagged with month,
    source and input file path. Registered sources are read under their
    contract; unless ``names`` picks some, every other CSV is read too, all
    columns as strings, under its file name without extension
    (``folder_report`` lists what was found, missing and unknown)."""
    found = {n: p for n, p in resolve_files(spark, folder, month, names).items() if p is not None}
    out = {n: scan_csv(spark, p, SOURCES[n]) for n, p in found.items()}
    if names is None:
        known = {os.path.basename(p) for p in found.values()}
        for f in sorted(_listdir(spark, folder)):
            if f not in known and f.lower().endswith(SUPPORTED):
                out[os.path.splitext(f)[0]] = scan_unknown(spark, os.path.join(folder, f))
    if with_metadata:
        out = {n: df.select("*", F.lit(month).alias("month"), F.lit(n).alias("source"),
                            F.col("_metadata.file_path").alias("file_path")) for n, df in out.items()}
    return out


def profile_table(df: DataFrame, name: str | None = None) -> DataFrame:
    """Rows and missing values per column in one aggregate, unpivoted to
    (source, column, dtype, rows, missing)."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.when(F.col(_q(f.name)).isNull(), F.lit(1))).alias(f"m{i}") for i, f in enumerate(fields)]
    r = df.agg(*aggs)
    each = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                     F.col(f"m{i}").alias("missing")) for i, f in enumerate(fields)]
    out = r.select(F.col("__rows").cast("long").alias("rows"), F.inline(F.array(*each)))
    out = out.select(F.lit(name).alias("source"), "column", "dtype", "rows", F.col("missing").cast("long"))
    return out


def table_preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """S6 preview: the first ``n`` rows in an explicit order (a top-n, so
    each partition keeps n rows and one small merge follows)."""
    return df.orderBy(*order_by).limit(n)


def months_of(df: DataFrame, month_col: str = "month") -> DataFrame:
    """S3 on data: distinct well-formed months with row counts."""
    m = F.col(month_col)
    return df.where(m.rlike(MONTH_RE)).groupBy(m.alias("month")).agg(F.count(F.lit(1)).cast("long").alias("rows"))


def latest_month_slice(df: DataFrame, month_col: str = "month") -> DataFrame:
    """Rows of the latest month. The max is a scalar subquery, so a
    table partitioned by month prunes to one partition at run time."""
    latest = df.where(F.col(month_col).rlike(MONTH_RE)).agg(F.max(month_col)).scalar()
    return df.where(F.col(month_col) == latest)


def latest_month_of(df: DataFrame, date_col: str) -> DataFrame:
    """S4/S9 on a table that has dates but no month column: rows from the
    first day of the latest date's month on. The bound is a scalar subquery on
    the plain date column, so it reaches the scan as a data filter."""
    first = df.agg(F.trunc(F.max(date_col), "month").cast(df.schema[date_col].dataType)).scalar()
    return df.where(F.col(date_col) >= first)


def projection_month(month_col) -> F.Column:
    """The month after ``month_col`` (``YYYY-MM``); NULL for anything that
    is not a well-formed month (no exception under ANSI mode)."""
    m = F.col(month_col) if isinstance(month_col, str) else month_col
    nxt = F.date_format(F.add_months(F.to_date(F.concat(m, F.lit("-01")), "yyyy-MM-dd"), 1), "yyyy-MM")
    return F.when(m.rlike(MONTH_RE), nxt)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = ("month",),
                fmt: str = "parquet", mode: str = "overwrite", one_file_per_partition: bool = False) -> None:
    """Write a table; with ``partitionOverwriteMode=dynamic`` an
    overwrite replaces only the partitions present in ``df``.

    ``one_file_per_partition`` first hash-partitions by the partition columns
    so each partition value is written by one task as one file (no small-file
    spray). Use it for entity-grain tables only (a cube month is a few
    thousand rows); for fact-sized tables it would put a whole month into
    one task."""
    if partition_by and one_file_per_partition:
        df = df.repartition(*partition_by)
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def export_csv(df: DataFrame, path: str, headers: list[str]) -> None:
    """Write a table as CSV with raw headers, the way monthly exports arrive.
    Every part file carries the header line; the scan skips it per file."""
    df.toDF(*headers).write.mode("overwrite").option("header", True).csv(path)
