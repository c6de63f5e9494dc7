"""Row cleaning operators (DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.functions import exprs as X
from gridcube.functions.headers import normalize_headers
from gridcube.operators.scan import fill_forward  # noqa: F401  (part of this module's interface)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip white space of any kind from every string column. NULL stays NULL
    (it is not turned into text)."""
    strs = set(string_columns(df))
    return df.select([X.strip(F.col(f"`{c}`")).alias(c) if c in strs else F.col(f"`{c}`")
                      for c in df.columns])


def basic_clean(df: DataFrame, variant: str = "base") -> DataFrame:
    """Header normalisation, string trim, then whole-row de-duplication.

    ``dropDuplicates`` is a hash aggregate on all columns with a map-side
    partial step, so repeated rows collapse before the shuffle.
    """
    return trim_strings(normalize_headers(df, variant)).dropDuplicates()


def clean_all(tables: dict[str, DataFrame], variant: str = "base") -> dict[str, DataFrame]:
    """Clean every table of a table set; keys are preserved, inputs untouched."""
    return {name: basic_clean(df, variant) for name, df in tables.items()}


def clean_key_column(df: DataFrame, key: str = "district") -> DataFrame:
    if key not in df.columns:
        raise KeyError(f"table has no '{key}' column after cleaning")
    return df.withColumn(key, X.clean_key(key))


def drop_rollup(df: DataFrame, key: str = "district", label: str = "total") -> DataFrame:
    """Remove rollup rows whose trimmed, lower-cased key equals ``label``.
    NULL keys are kept (they are reported by the null-key check)."""
    k = F.lower(X.strip(F.col(key)))
    return df.filter(k.isNull() | (k != F.lit(label.lower())))


def zfill_code(df: DataFrame, column: str = "awc_code", width: int = 11) -> DataFrame:
    return df.withColumn(column, X.zfill(column, width))


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill NULL with 0 in numeric columns (strings are left alone)."""
    return df.na.fill(0, subset=columns) if columns else df.na.fill(0)


def fill_missing(df: DataFrame, strategy: str = "zero", **kw) -> DataFrame:
    if strategy == "zero":
        return fill_zero(df, kw.get("columns"))
    if strategy == "ffill":
        return fill_forward(df, kw["columns"], kw["partition_by"], kw["order_by"])
    return df


def lenient_numeric(df: DataFrame, column: str, out: str | None = None, n: int = 2) -> DataFrame:
    return df.withColumn(out or column, X.lenient_num(column, n))


def listwise_drop(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any of ``columns``."""
    return df.na.drop(how="any", subset=columns)
