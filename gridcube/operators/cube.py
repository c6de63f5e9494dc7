"""Entity cube: left-join fold of per-source indicator tables.

Every source is aggregated to the key grain before it gets here, so each
right side holds one row per key. Joins are plain equi-joins on the key
list; the planner decides broadcast vs sort-merge from the measured size of
each side (``spark.sql.autoBroadcastJoinThreshold`` is the size check), so
nothing is broadcast on trust. Name collisions between sources are resolved
at schema time the way a pandas merge does it (``_x`` left, ``_y`` right).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping) if mapping else df


def left_join_key(left: DataFrame, right: DataFrame, keys: list[str],
                  suffixes: tuple[str, str] = ("_x", "_y"),
                  null_safe: bool = False) -> DataFrame:
    """Keep every left row; unmatched right columns are NULL; duplicate
    right keys fan out. Overlapping non-key names get ``suffixes``.

    ``null_safe`` makes NULL keys match each other (pandas merge semantics);
    by default NULL keys do not match and are reported by the quality checks.
    """
    overlap = [c for c in right.columns if c in set(left.columns) and c not in keys]
    left = _rename(left, {c: c + suffixes[0] for c in overlap})
    right = _rename(right, {c: c + suffixes[1] for c in overlap})
    if not null_safe:
        return left.join(right, on=keys, how="left")
    r = right.select([F.col(q(k)).alias(f"__r_{k}") for k in keys] +
                     [F.col(q(c)) for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = F.col(q(k)).eqNullSafe(F.col(f"__r_{k}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


def _plan_names(frames: dict[str, DataFrame], order: list[str], keys: list[str]):
    """Walk the fold on names alone, renaming exactly as ``left_join_key``
    does. Returns ({source: {original: final}}, [(column, left, right)])."""
    where: dict[str, tuple[str, str]] = {}          # current name -> (source, original)
    final: dict[str, dict[str, str]] = {s: {} for s in order}
    clashes = []
    for c in frames[order[0]].columns:
        if c not in keys:
            where[c] = (order[0], c)
    for name in order[1:]:
        for c in frames[name].columns:
            if c in keys:
                continue
            if c in where:
                src, orig = where.pop(c)
                clashes.append((c, src, name))
                final[src][orig] = c + "_x"
                where[c + "_x"] = (src, orig)
                final[name][c] = c + "_y"
                where[c + "_y"] = (name, c)
            else:
                where[c] = (name, c)
    return final, clashes


def collisions(frames: dict[str, DataFrame], order: list[str], keys: list[str]) -> list[tuple[str, str, str]]:
    """(column, left source, right source) for every name clash the fold
    suffixes."""
    return _plan_names(frames, order, keys)[1]


def final_names(frames: dict[str, DataFrame], order: list[str], keys: list[str]) -> dict[str, dict[str, str]]:
    """Per source, the renames the fold ends up applying (``_x``/``_y``)."""
    return _plan_names(frames, order, keys)[0]


def build_cube(frames: dict[str, DataFrame], order: list[str], keys: list[str]) -> DataFrame:
    """Fold of left joins, base source first, in registry order. The
    collision renames are computed on names first and applied once per
    source, so the fold itself is a chain of plain equi-joins. A source that
    lacks some keys (e.g. a static source without ``month``) joins on the
    keys it has."""
    ren = final_names(frames, order, keys)
    renamed = {s: _rename(frames[s], ren[s]) for s in order}
    cube = renamed[order[0]]
    for name in order[1:]:
        on = [k for k in keys if k in renamed[name].columns]
        cube = cube.join(renamed[name], on=on, how="left")
    lead = [k for k in keys if k in cube.columns]
    return cube.select(*[q(k) for k in lead], *[q(c) for c in cube.columns if c not in lead])
