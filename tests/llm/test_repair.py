import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridcube.llm import queries as Q
from gridcube.llm import repair as R
from gridcube.llm.roles import INITIALS, Repair
from tests.conftest import SF_CHECK

NEXT = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
FULL = {"u": "user", "a": "assistant"}


def cheapest(turns):
    """The least (cost, audit, new roles) by keeping every audit of a modest cost:
    ``turns`` are (initial, fault) with fault in 'kbdt'."""
    paths = {("0", ""): (0, ())}
    for role, fault in turns:
        new = {}
        for (state, audit), (cost, roles) in paths.items():
            at = [(state, audit, cost, roles)]
            for _ in range(4):
                for s, a, c, r in at:
                    options = [(s, "D", 4, r + (None,))]
                    if fault in "kt":
                        options += [(NEXT[s, x], "K", 0, r + (x,)) for x in role if (s, x) in NEXT]
                        options += [(NEXT[s, x], "R", 3, r + (x,)) for x in "ua" if (s, x) in NEXT]
                    for s2, letter, more, r2 in options:
                        k, v = (s2, a + letter), (c + more + 3 * (fault == "t" and letter != "D"), r2)
                        if k not in new or v[0] < new[k][0]:
                            new[k] = v
                at = [(NEXT[s, x], a + "I", c + 3, r + (x,)) for s, a, c, r in at for x in "ua" if (s, x) in NEXT]
        least = min(c for c, _ in new.values())
        paths = {k: v for k, v in new.items() if v[0] <= least + 10}
    tails = {"0": ("", ()), "a": ("", ()), "u": ("I", ("a",)), "s": ("II", ("u", "a"))}
    return min((c + 3 * len(tails[s][0]), a + tails[s][0], r + tails[s][1]) for (s, a), (c, r) in paths.items())


def by_hand(rows):
    """One conversation's result row, from its rows after damage as (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns, seen, counts = [], set(), dict.fromkeys("bdt", 0)
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "b" if not said else "d" if (role, text) in seen else "t" if said[-1] not in ".!?" else "k"
        seen.add((role, text))
        counts[fault] = counts.get(fault, 0) + 1
        turns.append((role[:1], fault))
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    cost, audit, roles = cheapest(turns)
    lines, at = [], iter(rows)
    for letter, new in zip(audit, roles):
        if letter == "I":
            lines.append(FULL[new] + ":")
        else:
            _, role, text = next(at)
            if letter != "D":
                lines.append((role if letter == "K" else FULL[new]) + ":" + text)
    return (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = lambda v: " " if v is None else str(v)
        k = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def expected(rows):
    groups = {r[0]: [] for r in rows}
    for conv, *rest in damage(rows):
        groups[conv].append(tuple(rest))
    return {c: by_hand(g) for c, g in groups.items()}


def result(spark, tmp, rows, schema="conv_id long, turn long, role string, text string"):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp}/conversations.parquet")
    return {r[0]: tuple(r)[1:] for r in Q.op11_repair(spark, tmp).collect()}


def test_query_equals_brute_force_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in Q.op11_repair(spark, SF_CHECK).collect()} == expected(rows)


def _rows(n, seed):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "ua"]
    texts = ["Yes.", "No", "What? ", "", " \t", None, "Ok!\n", "so on", "é。", "x" * 5000 + "."]
    return [(rnd.choice([None, *range(8)]), rnd.choice([None, *range(12)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("at_once", [1, 3, 4096])
def test_nulls_ties_and_chunks(spark, tmpdir_path, monkeypatch, at_once):
    """Chunks of one turn and of a few give the same result as whole conversations."""
    whole = R.repair
    monkeypatch.setattr(Q.repair, "repair", lambda t: whole(t, rows_at_once=at_once))
    rows = _rows(90, at_once)
    assert result(spark, tmpdir_path, rows) == expected(rows)


def test_text_ids_extra_columns_and_lost_conversations(spark, tmpdir_path):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(str(lost), 0, "user", "Hi."), ("b", 5, "assistant", "Fine."), ("b", 9, "user", "Hi.")]
    spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id string, turn int, role string, text string, chunk int, codes string") \
        .write.parquet(f"{tmpdir_path}/conversations.parquet")
    found = {r[0]: tuple(r)[1:] for r in Q.op11_repair(spark, tmpdir_path).collect()}
    assert found == expected(rows)
    assert found[str(lost)] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark, tmpdir_path):
    assert result(spark, tmpdir_path, []) == {}


def test_operator_returns_the_edited_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "And"), (1, 3, "user", " ")]
    fixed = R.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r.action, r.turn, r.role, r.text) for r in fixed.turns.orderBy("chunk", "k").collect()]
    cost, audit, _ = cheapest([("s", "k"), ("a", "k"), ("u", "t"), ("u", "b")])
    assert "".join(g[0] for g in got) == audit and fixed.conversations.first().cost == cost
    assert [g[2][0] for g in got if g[0] != "D"] in (list("su" "a"), list("suaua"))


def test_repeats_over_many_rows(spark, tmpdir_path):
    """One conversation with a third of all rows, all of them one turn's copies."""
    rows = [(7, i % 3, "user", "Same.") for i in range(60)] + [(i, 0, "user", "Hi.") for i in range(100, 220)]
    assert result(spark, tmpdir_path, rows) == expected(rows)


def test_machine_against_every_audit():
    machine, rnd = Repair(), random.Random(3)
    for n in range(300):
        codes = "".join(rnd.choice("0123456789abcdef" if n % 2 else "0004484c5") for _ in range(rnd.randint(0, 6)))
        cut = rnd.randint(0, len(codes))
        parts = [codes[:cut], codes[cut:]]
        cost, path, closing = machine.choose([machine.table(p) for p in parts])
        audit = "".join(e[0] for p, (a, b) in zip(parts, path) for e in machine.edits(p, a, b)) + "I" * len(closing)
        want = cheapest([(INITIALS[int(c, 16) // 4], "ktbd"[int(c, 16) % 4]) for c in codes])
        assert (cost, audit) == want[:2], codes


def test_digest_of_pieces(spark):
    from gridcube.llm.digests import running_sha256
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (None, 1, "é"), (2, 1, None), (1, 3, None)], "k long, o long, t string")
    got = {r.k: r.sha256 for r in running_sha256(rows, "k", "o", "t", "\n").collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {1: h("a\nb"), None: h("é"), 2: h("")}
    assert running_sha256(rows.where(F.lit(False)), "k", "o", "t", "\n").count() == 0
