"""Conversation repair against plain versions: all edits of short conversations, and suffix by suffix for whole tables."""

import hashlib
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

from hirelens.llm import conversation_repair, queries

from .conftest import SMALL

PATTERN = re.compile(r"(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def every_edit(rows):
    """rows: (initial, gone, truncated). (cost, audit) least of all edits, with up to two insertions at a place."""
    inserts = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    best = None
    options = []
    for initial, gone, cut in rows:
        one = [("D", 2, "")]
        if not gone:
            one += [("K", 5 * cut, initial), ("R", 1 + 5 * cut, "u"), ("R", 1 + 5 * cut, "a")]
        options.append([("I" * len(p) + x, 5 * len(p) + c, "".join(p) + r) for p in inserts for x, c, r in one])
    options.append([("I" * len(p), 5 * len(p), "".join(p)) for p in inserts])
    for way in itertools.product(*options):
        if PATTERN.fullmatch("".join(w[2] for w in way)):
            found = sum(w[1] for w in way), "".join(w[0] for w in way)
            best = found if best is None else min(best, found)
    return best


def suffixes(rows):
    """The same for rows of any number, from the end; the audit's choices with the roles they give."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {s: (0, "", ()) if s in ("", "a") else (1 << 30, "", ()) for s in ("", "s", "u", "a")}

    def inserted(best):
        for _ in range(4):
            for s in list(best):
                for r in "ua":
                    if (s, r) in step:
                        cost, audit, roles = best[step[s, r]]
                        best[s] = min(best[s], (5 + cost, "I" + audit, (r, *roles)))
        return best

    best = inserted(best)
    for initial, gone, cut in reversed(rows):
        new = {}
        for s in best:
            cost, audit, roles = best[s]
            ways = [(2 + cost, "D" + audit, roles)]
            for r, letter, extra in [] if gone else [(initial, "K", 0), ("u", "R", 1), ("a", "R", 1)]:
                if (s, r) in step:
                    cost, audit, roles = best[step[s, r]]
                    ways.append((cost + extra + 5 * cut, letter + audit, (r, *roles)))
            new[s] = min(ways)
        best = inserted(new)
    return best[""]


def plain(rows):
    """rows: (conv_id, turn, role, text). The contract's row for every conversation; rows of one turn in any order."""
    found = {}
    for conv, turn, role, text in rows:
        group = found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub(r"[.!?]", "", text) if kind == 2 else text
        group += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, group in found.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, shapes, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in group:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            shapes.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, _, _ in group if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(shapes, shapes[1:]))
        cost, audit, roles = suffixes(tuple(shapes))
        lines, left, given = [], list(group), list(roles)
        for letter in audit:
            if letter == "I":
                lines.append(NAMES[given.pop(0)] + ":")
                continue
            _, role, text = left.pop(0)
            if letter != "D":
                r = given.pop(0)
                lines.append(f"{role if letter == 'K' else NAMES[r]}:{text}")
        out[conv] = (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def got(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def char(initial, gone, cut):
    return conversation_repair._GONE[initial] if gone else initial.upper() if cut else initial


def test_solver_equals_all_edits():
    shapes = [(i, False, cut) for i in "suao" for cut in (False, True)] + [("u", True, False)]
    solver = conversation_repair.Solver()
    for n in range(4):
        for rows in itertools.product(shapes, repeat=n) if n < 3 else itertools.islice(itertools.product(shapes, repeat=3), 0, None, 29):
            assert solver.solve("".join(char(*r) for r in rows)) == every_edit(rows) == suffixes(rows)[:2], rows


def test_solver_equals_suffixes_on_long_signatures():
    import random

    r, solver = random.Random(3), conversation_repair.Solver()
    for _ in range(300):
        rows = tuple((r.choice("suao"), g := r.random() < 0.2, not g and r.random() < 0.3) for _ in range(r.randrange(40)))
        assert solver.solve("".join(char(*x) for x in rows)) == suffixes(rows)[:2]
    # Steps recur: far fewer are solved than there are rows.
    assert len(solver.before) < 2000
    cost, audit = solver.solve("ua" * 100_000)
    assert cost == 0 and audit == "K" * 200_000


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_whole_tables(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_conversation_repair(spark, folder)) == plain(rows)


def test_nulls_ties_long_texts_and_clashing_names(spark):
    rows = [(1, None, "user", "Hi."), (1, None, "user", "Hi."), (1, 3, None, "x."), (1, 9, "assistant", None), (2, 0, "", "a."), (None, 1, "user", "Q?"), (None, 2, "assistant", "A."), (None, 2, "assistant", "A.")]
    rows += [(3, t, "system" if not t else "user" if t % 2 else "assistant", "Long. " * 200_000 if t == 1 else f"T{t}.") for t in range(7)] + [(4, t, "Élan", "é!") for t in range(5)]
    dropped = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"kind": F.lit("x"), "copies": F.lit(7), "audit": F.lit(1), "d1": F.lit("y")})
    found = got(conversation_repair.repair(conversation_repair.damaged(df.repartition(5))))
    assert found == plain(rows)
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    # Different rows of one turn: in one order, whatever the partitions are.
    ties = df.select(*conversation_repair.ROW.replace(" long", "").replace(" string", "").split(", ")).unionByName(spark.createDataFrame([(1, 3, "user", f"t{i}.") for i in range(9)], conversation_repair.ROW))
    a, b = (got(conversation_repair.repair(conversation_repair.damaged(ties.repartition(n)))) for n in (1, 7))
    assert a == b


def test_a_conversation_over_many_partitions(spark):
    """One conversation holds most rows; its pieces lie in many partitions and batches."""
    rows = [(5, t, ("user", "assistant")[t % 2], f"m{t % 900}.") for t in range(3000)] + [(6, t, "user", "Same.") for t in range(40)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = spark.createDataFrame(rows, conversation_repair.ROW)
        assert got(conversation_repair.repair(conversation_repair.damaged(df))) == plain(rows)
        assert conversation_repair._pieces(conversation_repair._faults(conversation_repair.damaged(df))).where("conv_id = 5").count() > 10
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_an_empty_table(spark):
    assert conversation_repair.repair(conversation_repair.damaged(spark.createDataFrame([], conversation_repair.ROW))).collect() == []
