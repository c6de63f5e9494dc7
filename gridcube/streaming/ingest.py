"""Monthly ingest, batch and incremental.

The batch job and the streaming job share one clean function, so an
incremental run and a full rerun produce the same rows. The streaming form
is a file-source stream with ``trigger(availableNow=True)``: every file
that has arrived is processed once, progress is kept in the checkpoint, and
each micro-batch is written by ``foreachBatch``.

Rerun safety: each micro-batch writes its rows under (month, batch_id) with
dynamic partition overwrite, so a replayed batch (same id, e.g. after a
failure between the write and the checkpoint commit) replaces exactly its
own partitions instead of appending twice. Overwriting a whole month is
avoided on purpose: a month spread over several micro-batches would lose
rows. A batch leaves out rows that earlier batches stored, found through a
history of row hashes, so readers only drop the batch id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcube.operators.clean import basic_clean
from gridcube.session import cleanup, mark, materialize
from gridcube.sources.files import path_exists


def tag_month(df: DataFrame, ts_col: str, source: str) -> DataFrame:
    """Month from a timestamp plus the source label."""
    return df.withColumns({"month": F.date_format(F.col(ts_col), "yyyy-MM"), "source": F.lit(source)})


def clean_batch(df: DataFrame, ts_col: str, source: str) -> DataFrame:
    """S13's per-batch work: normalise headers, trim, de-duplicate, tag."""
    return tag_month(basic_clean(df), ts_col, source)


def ingest_batch(df: DataFrame, ts_col: str, source: str) -> DataFrame:
    return clean_batch(df, ts_col, source)


def ingest_stream(spark: SparkSession, src_dir: str, schema, out_path: str, checkpoint: str,
                  ts_col: str, source: str, fmt: str = "parquet", glob: str | None = None,
                  clean: Callable[[DataFrame, str, str], DataFrame] = clean_batch,
                  max_files_per_trigger: int = 1000) -> None:
    """Process every file that has arrived under ``src_dir`` (availableNow)
    and write the cleaned rows to ``out_path`` partitioned by month. A large
    backlog is split into micro-batches of at most ``max_files_per_trigger``
    files, so no single batch has to hold all of it. The slot of a row's history is
    its day, where the cleaned rows keep ``ts_col``."""
    reader = (spark.readStream.schema(schema).format(fmt)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.load(src_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = clean(batch, ts_col, source)
        write_batch(rows, batch_id, out_path, F.dayofmonth(F.col(f"`{ts_col}`")) if ts_col in rows.columns else None)

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


HISTORY = "_history"             # hidden from readers of the table
HASH_SLOTS = 64


def _hashed(rows: DataFrame, cols: list[str], slot) -> DataFrame:
    """``rows`` and two independent hashes of the row, and its slot: equal rows
    lie in equal slots."""
    c = [F.col(f"`{x}`") for x in cols]
    slot = F.pmod(F.xxhash64(*c), F.lit(HASH_SLOTS)) if slot is None else slot
    return rows.withColumns({"__h": F.xxhash64(*c), "__g": F.xxhash64(F.lit("g"), *c), "__slot": F.coalesce(slot.cast("string"), F.lit("none"))})


def _partition(name: str, value) -> str:
    return f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def _stored(spark: SparkSession, base: str, folders: list[str]) -> DataFrame | None:
    """The files under the given partition folders of a table, and no others."""
    there = [f"{base}/{f}" for f in folders if path_exists(spark, f"{base}/{f}")]
    return spark.read.option("basePath", base).parquet(*there) if there else None


def _write_history(hashed: DataFrame, out_path: str) -> None:
    (hashed.select("month", "batch_id", F.col("__slot").alias("slot"), F.col("__h").alias("h"), F.col("__g").alias("g")).hint("rebalance", "month", "slot")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "slot", "batch_id").parquet(f"{out_path}/{HISTORY}"))


def earlier_batches(batch: DataFrame, batch_id: int, out_path: str) -> tuple[list[tuple], list[str]]:
    """The (month, batch) partitions that may hold a row of ``batch`` (hashed
    rows), and the history files read to find them: those of the batch's own months
    and slots, whatever else is stored. Both lists are of partitions, not of rows."""
    spark = batch.sparkSession
    touched = [(r.month, r["__slot"]) for r in batch.select("month", "__slot").distinct().collect()]
    seen = _stored(spark, f"{out_path}/{HISTORY}", [f"{_partition('month', m)}/{_partition('slot', s)}" for m, s in touched])
    if seen is None:
        return [], []
    hits = seen.where(F.col("batch_id") < batch_id).select(F.col("month").cast("string").alias("m"), F.col("batch_id").cast("long").alias("b"), "h", "g") \
        .join(batch.select(F.col("__h").alias("h"), F.col("__g").alias("g")), ["h", "g"], "left_semi")
    return [(r.m, r.b) for r in hits.select("m", "b").distinct().collect()], seen.inputFiles()


def write_batch(rows: DataFrame, batch_id: int, out_path: str, slot=None) -> None:
    """Idempotent per-batch write: replaces the (month, batch_id) partitions of
    this batch only. Rows that an earlier batch stored are left out.

    Beside the table lies its history: two hashes of every stored row, in folders
    by month, slot and batch. ``slot`` is an expression over the row, such as its
    day (by default one of 64 hash slots); a repeat has its original's slot, so a
    batch reads the history of its own months and slots only: with days as slots,
    what it reads follows the batch and not what the months hold by now. A table
    keeps one kind of slot for good. Stored
    rows themselves are opened only where both hashes meet, batch by batch, and
    compared value by value. A table from before there was a history gets one first.
    A rebalance by month sizes the files (small months share a task, large ones are split)."""
    spark, cols, start = rows.sparkSession, rows.columns, mark()
    batch = materialize(_hashed(rows, cols, slot), "batch")
    if path_exists(spark, out_path):
        if not path_exists(spark, f"{out_path}/{HISTORY}"):
            _write_history(_hashed(spark.read.parquet(out_path).withColumn("batch_id", F.col("batch_id").cast("long")), cols, slot), out_path)
        found, _ = earlier_batches(batch, batch_id, out_path)
        old = _stored(spark, out_path, [f"{_partition('month', m)}/{_partition('batch_id', b)}" for m, b in found])
        if old is not None:
            old = old.withColumn("month", F.col("month").cast("string"))
            old = old.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in cols], F.xxhash64(*[F.col(f"`{c}`") for c in cols]).alias("__o"))
            same = F.col("__h") == F.col("__o")
            for c in cols:
                same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`"))
            batch = batch.join(old, same, "left_anti")
    batch = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
    (batch.drop("__h", "__g", "__slot").hint("rebalance", "month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "batch_id").parquet(out_path))
    _write_history(batch, out_path)
    cleanup(spark, start)


def read_ingested(spark: SparkSession, out_path: str) -> DataFrame:
    """Rows of the ingested table, without the batch bookkeeping. Rows are
    unique as stored, so reading is a plain scan."""
    return spark.read.parquet(out_path).drop("batch_id")
