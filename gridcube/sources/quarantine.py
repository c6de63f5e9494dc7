"""CSV exports with bad lines: the month goes on, the lines are set aside.

A file is read as lines and parsed under its contract in one pass, whose result
is written once with the faults of every line. Lines without fault are the
table; the others go, with file, line number and reasons, to a side table. Line
numbers come from a line's place in its split and the lines of the splits before
it in the file (one row a split).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcube.functions import exprs as X
from gridcube.functions.headers import normalize_names, number_duplicates
from gridcube.session import materialize
from gridcube.sources.files import MISSING, SUPPORTED, read_header
from gridcube.sources.registry import SourceSpec, header_matches

BAD = "source string, file_path string, line long, reason string, text string"


class TooManyBadLines(ValueError):
    """More lines of a source are bad than the job allows."""


def scan_lines(spark: SparkSession, path: str, spec: SourceSpec, max_bad: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of an export. The rows are those of ``scan_csv`` with
    ``file_path``, without the lines that have too few or too many fields or a text
    where the contract has a number; these are in the second table with every
    reason. Empty lines and each part's header line are neither. A header that breaks
    the contract is an error, and so is a share of bad lines above ``max_bad``."""
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in SUPPORTED:
        raise ValueError(f"{path}: only {', '.join(SUPPORTED)} files can be scanned, not {ext or 'a file without extension'}")
    header = [h.lstrip("﻿") for h in read_header(spark, path)]
    wrong = [(exp, found) for exp, found, ok in header_matches(spec, header) if not ok]
    if wrong:
        raise KeyError(f"{spec.name}: header does not match contract: {wrong}")
    names = [f"_{i}" for i in range(len(header))]
    parsed = T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField("__bad", T.StringType())])
    first = F.col("__start") == 0
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("__start"),
                                         F.monotonically_increasing_id().alias("__id"))
    row = F.from_csv(F.col("value"), parsed.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    schema = spec.schema()
    text = lambda i: F.col(f"r.{names[i]}")
    faults = [F.when(F.col("r.__bad").isNotNull() | F.col("r").isNull(), F.lit("wrong number of fields or broken quotes"))]
    cells = []
    for i, f in enumerate(schema):
        s = X.strip(text(i))
        if isinstance(f.dataType, T.StringType):
            cells.append(text(i).alias(f.name))
            continue
        cells.append(F.when(~s.isin(*MISSING), s).try_cast(f.dataType).alias(f.name))
        unreadable = s.isNotNull() & ~s.isin(*MISSING) & s.try_cast(f.dataType).isNull()
        faults.append(F.when(unreadable, F.concat(F.lit(f"{f.name}: "), s, F.lit(f" is no {f.dataType.simpleString()}"))))
    extra = number_duplicates(normalize_names(header[len(schema):], spec.variant))
    cells += [text(i).alias(f"{n}_extra" if n in schema.names else n) for i, n in enumerate(extra, len(schema))]
    each = lines.withColumn("r", row).withColumn("__faults", F.array_compact(F.array(*faults)))
    t = materialize(each.select(*cells, "file_path", "__start", "__id", "value", F.concat_ws("; ", "__faults").alias("__reason")), "lines")

    # a split's lines have neighbouring numbers; those of the splits before it in the file come first
    splits = t.groupBy("file_path", "__start").agg(F.min("__id").alias("__lo"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy("file_path").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file_path", "__start", "__lo", (F.coalesce(before, F.lit(0)) + 1 - F.col("__lo")).alias("__add"))
    heads = splits.where(first).select(F.col("__lo").alias("__id"))
    body = t.join(heads, "__id", "left_anti").where(F.trim("value") != "")
    good = body.where("__reason = ''").drop("__start", "__id", "value", "__reason")
    bad = body.where("__reason <> ''").join(splits, ["file_path", "__start"]).select(
        F.lit(spec.name).alias("source"), "file_path", (F.col("__id") + F.col("__add")).alias("line"), F.col("__reason").alias("reason"), F.col("value").alias("text"))
    if max_bad < 1.0:
        n = body.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__reason") != "").alias("b")).first()
        if n.n and n.b / n.n > max_bad:
            raise TooManyBadLines(f"{spec.name}: {n.b} of {n.n} lines are bad, {max_bad:.1%} are allowed")
    return good, bad
