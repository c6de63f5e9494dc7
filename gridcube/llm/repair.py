"""Conversation structure repair on Spark: the cheapest edits that give every
conversation the role grammar of ``roles``.

Turns are range-partitioned by (conversation, turn), so a conversation of any
length is spread over as many tasks as its size needs, and lie in chunks of one
Arrow slice at most. A turn's first appearance is found by a minimum per
(conversation, digest), which collapses repeats before the shuffle. Every chunk is
parsed on its own from each stack top; a conversation's small chunk tables are then
combined in order, and each chunk writes its edits between the tops chosen for it.
Only chunk tables of one conversation meet in a task, one at a time.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcube.llm.batches import small
from gridcube.llm.roles import Repair, cached
from gridcube.session import materialize

SPACE = "\t\n\x0b\x0c\r "
LEGAL = {"su", "ua", "au"}
OPS = "array<struct<action:string,src:int,role:string>>"
_OPS = pa.list_(pa.struct([("action", pa.string()), ("src", pa.int32()), ("role", pa.string())]))


class Repaired(NamedTuple):
    turns: DataFrame
    conversations: DataFrame


def _chunks(rows: DataFrame, rows_at_once: int) -> DataFrame:
    """(conv, chunk, turns, roles, texts): the turns of a conversation in order,
    cut where a slice, a partition or ``rows_at_once`` ends. Chunk numbers rise along it."""
    def cut(batches):
        p, k = TaskContext.get().partitionId(), 0
        for whole in batches:
            for part in small([whole], 3):
                for at in range(0, part.num_rows, rows_at_once):
                    b = part.slice(at, rows_at_once)
                    conv = b.column(0).to_pylist()
                    first = [i for i in range(len(conv)) if not i or conv[i] != conv[i - 1]]
                    ends = pa.array([*first, len(conv)], pa.int32())
                    flat = [pa.concat_arrays([b.column(i)]) for i in (1, 2, 3)]
                    number = np.arange(k, k + len(first), dtype=np.int64) + (p << 40)
                    k += len(first)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(first, pa.int32())), pa.array(number),
                                                      *[pa.ListArray.from_arrays(ends, f) for f in flat]], names=["conv", "chunk", "turns", "roles", "texts"])

    schema = rows.select("conv", F.lit(0).cast("long").alias("chunk"), F.array("turn").alias("turns"), F.array("role").alias("roles"), F.array("text").alias("texts")).schema
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("id")]
    # the row's number only parts rows that are equal otherwise
    return rows.withColumn("id", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order) \
        .select("conv", "turn", "role", "text").mapInArrow(cut, schema)


def _codes(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, codes, turns seen): a hex digit per turn, its role * 4 and
    its first fault; what a turn's text and role repeat is looked up over the whole conversation."""
    initial = lambda r: F.when(F.substring(r, 1, 1).isin("s", "u", "a"), F.instr(F.lit("sua"), F.substring(r, 1, 1)) - 1).otherwise(F.lit(3))
    said = lambda t: F.rtrim(t, F.lit(SPACE))
    own = lambda r, t: (initial(r) * 4 + F.when(said(t) == "", 2).when(F.right(said(t), F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)).cast("int")
    zipped = F.transform(F.arrays_zip("roles", "texts"), lambda z: F.struct(own(z.roles, z.texts).alias("code"),
                         F.unhex(F.sha2(F.concat(z.roles, F.lit("\0"), z.texts), 256)).alias("digest")))
    known = materialize(chunks.select("conv", "chunk", "turns", zipped.alias("z")), "turn-codes")
    each = known.select("conv", "chunk", F.posexplode("z").alias("at", "z")).where(F.col("z.code") % 4 != 2)
    first = each.groupBy("conv", "z.digest").agg(F.min(F.struct("chunk", "at")).alias("f")).groupBy("f.chunk").agg(F.collect_list("f.at").alias("firsts"))
    there = F.filter("turns", lambda t: t.isNotNull())
    return known.select("conv", "chunk", F.transform("z", lambda z: z.code).alias("own"), F.size(F.array_distinct(there)).cast("long").alias("different"),
                        F.array_min(there).alias("low"), F.array_max(there).alias("high"),
                        F.get("turns", F.lit(0)).alias("first_turn"), F.get("turns", F.size("turns") - 1).alias("last_turn")) \
        .join(first, "chunk", "left")


def _tables(codes: DataFrame, repair: Repair) -> DataFrame:
    """A chunk's final codes, its counts and its (entry, exit) table, packed as
    entry, exit, cost, rank."""
    n = codes.columns.index
    own_at, first_at, chunk_at = n("own"), n("firsts"), n("chunk")
    keep = [c for c in codes.columns if c not in ("own", "firsts")]
    added = "codes string, blank long, seen long, cut long, illegal long, ends string, packed array<long>"

    def run(batches):
        table, _ = cached(repair)
        for b in small(batches, own_at):
            out = [[] for _ in range(7)]
            for own, firsts in zip(b.column(own_at).to_pylist(), b.column(first_at).to_pylist()):
                firsts = set(firsts or ())
                final = [c if c % 4 == 2 or i in firsts else c // 4 * 4 + 3 for i, c in enumerate(own)]
                text, roles = "".join("0123456789abcdef"[c] for c in final), "".join("suax"[c // 4] for c in final)
                faults = [c % 4 for c in final]
                packed = [v for entry, row in enumerate(table(text)) for top, (cost, rank) in row.items() for v in (entry, top, cost, rank)]
                for column, v in zip(out, (text, faults.count(2), faults.count(3), faults.count(1),
                                           sum(roles[i:i + 2] not in LEGAL for i in range(len(roles) - 1)), roles[0] + roles[-1], packed)):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n(c)) for c in keep], pa.array(out[0], pa.string()), *[pa.array(v, pa.int64()) for v in out[1:5]], pa.array(out[5], pa.string()),
                 pa.array(out[6], pa.list_(pa.int64()))], names=[*keep, "codes", "blank", "seen", "cut", "illegal", "ends", "packed"])

    from pyspark.sql.types import StructType, _parse_datatype_string
    schema = StructType(codes.select(*keep).schema.fields + _parse_datatype_string(added).fields)
    return codes.mapInArrow(run, schema)


def _chosen(tables: DataFrame, repair: Repair) -> DataFrame:
    """Per chunk: its entry and exit top, what is inserted behind it, whether it
    is its conversation's only one, and its part of the conversation's figures."""
    cols = ["conv", "chunk", "different", "low", "high", "first_turn", "last_turn", "blank", "seen", "cut", "illegal", "ends", "packed"]
    rows = tables.select(*cols).repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "chunk")
    conv_type = rows.schema["conv"]
    fields = "chunk long, entry int, top int, closing string, only boolean, different long, low long, high long, blank long, seen long, cut long, illegal long, cost long"
    from pyspark.sql.types import StructType, _parse_datatype_string
    schema = StructType([conv_type] + _parse_datatype_string(fields).fields)

    def finish(some):
        """The output rows of one conversation's chunks."""
        parsed = []
        for r in some:
            table, p = [{} for _ in repair.tops], r[12]
            for i in range(0, len(p), 4):
                table[p[i]][p[i + 1]] = (p[i + 2], p[i + 3])
            parsed.append(table)
        cost, path, closing = repair.choose(parsed)
        for i, (r, (entry, top)) in enumerate(zip(some, path)):
            before, end = some[i - 1] if i else None, i == len(some) - 1
            joint = int(before is not None and before[11][1] + r[11][0] not in LEGAL)
            again = int(before is not None and r[5] is not None and before[6] == r[5])
            yield (r[0], r[1], entry, top, closing if end else "", len(some) == 1, r[2] - again, r[3], r[4], r[7], r[8], r[9], r[10] + joint, cost if end else 0)

    def run(batches):
        held, conv_arrow = [], None
        for b in batches:
            out = []
            conv_arrow = b.schema.field(0).type
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[0][0] != r[0]:
                    out += finish(held)
                    held = []
                held.append(r)
            yield _rows(out, conv_arrow)
        if held:
            yield _rows(list(finish(held)), conv_arrow)

    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), *[pa.int64()] * 8]
    names = [f.name for f in schema.fields]

    def _rows(out, conv_arrow):
        columns = list(zip(*out)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [conv_arrow, *kinds])], names=names)

    return rows.mapInArrow(run, schema)


def _edits(chosen: DataFrame, repair: Repair) -> DataFrame:
    """(chunk, only, ops) of (chunk, codes, entry, top, closing, only) rows."""
    def run(batches):
        _, edits = cached(repair)
        for b in small(batches, 1):
            found = []
            for codes, entry, top, closing in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 4))):
                ops = edits(codes, entry, top) + [("I", -1, {"u": "user", "a": "assistant"}[x]) for x in closing]
                found.append([dict(zip(("action", "src", "role"), o)) for o in ops])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(5), pa.array(found, _OPS)], names=["chunk", "only", "ops"])

    return chosen.select("chunk", "codes", "entry", "top", "closing", "only").mapInArrow(run, f"chunk long, only boolean, ops {OPS}")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           rows_at_once: int = 4096) -> Repaired:
    """``turns`` of the result: (conv, chunk, only, k, action, turn, role, text) in
    the order (chunk, k) within a conversation; action is K(eep), R(erole), D(elete) or
    I(nsert), role and text are those after the edit, and a deleted turn keeps its own.
    ``only`` tells that a conversation is one chunk. ``conversations``: per
    conversation its gaps, blank, duplicate, truncated, illegal and cost.

    NULL roles and texts are one space, a NULL turn sorts first and a NULL
    conversation is one of its own; turns of one number go by role, then text;
    rows that are wholly alike are each other's duplicates; empty texts are blank,
    very long ones are read whole; an empty table gives no rows. Extra columns,
    whatever their names, are not read. A conversation may hold any share of the rows."""
    one = F.lit(" ")
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`"), one).alias("role"), F.coalesce(F.col(f"`{text_col}`"), one).alias("text"))
    machine = Repair()
    chunks = materialize(_chunks(rows, rows_at_once), "turn-chunks", codec="zstd")
    tables = materialize(_tables(_codes(chunks), machine), "turn-tables")
    chosen = materialize(_chosen(tables, machine), "turn-choices")
    ops = _edits(chosen.drop("conv").join(tables.select("chunk", "codes"), "chunk"), machine)
    each = chunks.join(ops, "chunk").select("conv", "chunk", "only", "turns", "roles", "texts", F.posexplode("ops").alias("k", "op"))
    src = F.when(F.col("op.src") >= 0, F.col("op.src"))
    edited = each.select("conv", "chunk", "only", "k", F.col("op.action").alias("action"), F.get("turns", src).alias("turn"),
                         F.coalesce("op.role", F.get("roles", src)).alias("role"), F.coalesce(F.get("texts", src), F.lit("")).alias("text"))
    figures = chosen.groupBy("conv").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("different"), F.lit(0).cast("long")).alias("gaps"), F.sum("blank").alias("blank"),
        F.sum("seen").alias("duplicate"), F.sum("cut").alias("truncated"), F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    return Repaired(edited, figures)
