"""Header normalisation (driver-side metadata, applied with ``toDF``).

Header work never touches rows: it maps a list of names to a list of names,
and the DataFrame is re-labelled with ``df.toDF(*names)`` (zero plan cost).
Every replace is literal and a single left-to-right pass, so three spaces
become ``a__b`` (the ``__`` -> ``_`` step runs once).
"""

from __future__ import annotations

import re

# The per-source header variants. Each is the list of literal
# replacements applied after strip + lower-case + ' ' -> '_', in order.
VARIANTS: dict[str, list[tuple[str, str]]] = {
    "base": [("__", "_")],
    "ag": [("(", ""), (")", ""), ("%", "pct"), ("__", "_")],
    "gwg": [(".", ""), ("__", "_")],
    "lbw": [("-", "_"), ("__", "_")],
    "me": [("%", "pct"), ("__", "_")],
    "snp": [("(", ""), (")", ""), ("-", "_"), ("__", "_")],
}


def normalize_name(name: str, variant: str = "base") -> str:
    s = name.strip().lower().replace(" ", "_")
    for old, new in VARIANTS[variant]:
        s = s.replace(old, new)
    return s


def normalize_names(names: list[str], variant: str = "base") -> list[str]:
    return [normalize_name(n, variant) for n in names]


def normalize_col(c, variant: str = "base"):
    """The same rule as ``normalize_name`` as a Spark Column expression, for
    header text held as data (e.g. a catalogue of many files' header rows)."""
    from pyspark.sql import functions as F
    from gridcube.functions.exprs import strip
    s = F.replace(F.lower(strip(c)), F.lit(" "), F.lit("_"))
    for old, new in VARIANTS[variant]:
        s = F.replace(s, F.lit(old), F.lit(new))
    return s


def strict_name(name: str) -> str:
    """Strict variant: strip, ' ' -> '_', drop anything outside
    ``[A-Za-z0-9_]``, lower-case. No ``__`` collapse."""
    s = name.strip().replace(" ", "_")
    return re.sub(r"[^A-Za-z0-9_]", "", s).lower()


def strict_col(c):
    """``strict_name`` as a Column expression."""
    from pyspark.sql import functions as F
    from gridcube.functions.exprs import strip
    return F.lower(F.regexp_replace(F.replace(strip(c), F.lit(" "), F.lit("_")), "[^A-Za-z0-9_]", ""))


def number_duplicates(names: list[str]) -> list[str]:
    """Label repeated headers ``x``, ``x.1``, ``x.2`` (blank -> ``Unnamed: i``),
    the convention spreadsheet exports are usually read with."""
    out, seen = [], {}
    taken = set()
    for i, n in enumerate(names):
        if n is None or n.strip() == "":
            n = f"Unnamed: {i}"
        base, k = n, seen.get(n, 0)
        cand = base if k == 0 else f"{base}.{k}"
        while cand in taken:
            k += 1
            cand = f"{base}.{k}"
        seen[base] = k + 1
        taken.add(cand)
        out.append(cand)
    return out


def number_duplicates_by(headers, file: str, position: str, header: str):
    """``number_duplicates`` for the headers of many files held as rows: (file,
    position, header, label). A file's headers meet in one row, which is as wide as
    the file has columns."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    rows = headers.groupBy(F.col(file).alias(file)).agg(F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), F.col(header).alias("h")))).alias("e"))
    rows = rows.select(file, F.transform("e", lambda e: e.p).alias("p"), F.transform("e", lambda e: e.h).alias("h"))
    schema = rows.withColumn("label", F.array(F.lit(""))).schema

    def run(batches):
        for b in batches:
            labels = [number_duplicates(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(labels, pa.list_(pa.string()))], names=[*b.schema.names, "label"])

    out = rows.mapInArrow(run, schema).select(file, F.inline(F.arrays_zip("p", "h", "label")))
    return out.select(file, F.col("p").alias(position), F.col("h").alias(header), "label")


def rename_map(df_columns: list[str], mapping: dict[str, str]) -> list[str]:
    """Apply a rename dict; names missing from the dict are kept."""
    return [mapping.get(c, c) for c in df_columns]


def apply_names(df, names: list[str]):
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def normalize_headers(df, variant: str = "base"):
    """Normalise the column names of a DataFrame (metadata only)."""
    return apply_names(df, normalize_names(df.columns, variant))


def missing_columns(columns: list[str], required: list[str]) -> list[str]:
    have = set(columns)
    return [c for c in required if c not in have]


def require_columns(columns: list[str], required: list[str], what: str = "table") -> None:
    miss = missing_columns(columns, required)
    if miss:
        raise KeyError(f"{what} lacks required columns: {miss}")
