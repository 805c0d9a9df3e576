"""Conversation structure repair: signature deduplication, one solution a distinct signature, edits replayed.

A conversation's rows in order become a string with a character a row: the initial of its role and its fault. Conversations share few such
signatures, so each distinct one is solved once, by recursion from its end: the least cost of repairing a suffix, from each state of
the wanted pattern of roles, follows from the next character and from the costs after it, and is remembered by these two (costs less
their least one take few values). The cheapest edits that come first in ASCII order are then walked from the start. The solutions are
joined back by signature, and a last pass replays each conversation's edits over its rows.

Duplicates are found by an aggregate over role and text digest; the order of rows comes from one range partitioning of digests by
(conversation, turn), so a conversation that holds a third of all rows is dealt over many tasks and its signature put together from
pieces. The texts are shuffled once, to be replayed: sorted by Spark, streamed through Python batch by batch, so memory does not follow
a conversation's length (beyond its signature and audit, a character a row). A digest of a whole conversation is sequential, so the
replay of one conversation is one task.

Defined results: a null conv_id is a conversation of its own; a null turn comes first and does not count for gaps; a null role or text is
one space. Rows of one turn are in the order of role and text digest, repeated rows beside each other. A role's initial is its first
character (an empty role, as any other initial, fits nowhere). A conversation without rows after damage has no faults, an empty audit and
the digest of an empty string; an empty table gives no rows. Other columns, whatever their names, are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise

#: Costs of edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the role pattern (s?(ua)+)?: nothing yet, after the system role, after a user, after an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant is put where the pattern wants one.
_NEXT = (USER, USER, ASSISTANT, USER)
_WANTED = ("user", "user", "assistant", "user")
_NEVER = 1 << 40
#: Costs after the last row: what inserts the pattern still needs.
_END = (0, 2 * INSERT, INSERT, 0)

ROW = "conv_id long, turn long, role string, text string"
#: Signature characters: a role's initial, upper case where truncated; of rows that have to go, their initial as a digit.
_GONE = {"s": "0", "u": "1", "a": "2", "o": "3"}
_INITIAL = {c: i for i, g in _GONE.items() for c in (i, i.upper(), g)}


def _fits(initial: str, state: int) -> int | None:
    """The state after keeping a row of this initial, if it may be kept."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


class Solver:
    """Cheapest edits of signatures; steps that recur are solved once."""

    def __init__(self):
        self.before: dict[tuple[str, tuple], tuple[int, tuple]] = {}
        self.walked: dict[tuple[str, tuple, int], tuple[str, int]] = {}

    @staticmethod
    def _choices(c: str, state: int) -> Iterator[tuple[str, int, int]]:
        """(letter, cost, state after) of every edit of the row, in ASCII order of letters, without insertions."""
        yield "D", DELETE, state
        if c.isdigit():
            return
        more = TRUNCATED if c.isupper() else 0
        kept = _fits(c.lower(), state)
        if kept is not None:
            yield "K", KEEP + more, kept
        yield "R", REROLE + more, _NEXT[state]

    def _before(self, c: str, after: tuple) -> tuple[int, tuple]:
        """(least, costs less the least) before the row, of the costs after it, by state."""
        found = self.before.get((c, after))
        if found is None:
            costs = [min(cost + after[then] for _, cost, then in self._choices(c, state)) for state in range(4)]
            for _ in range(3):  # up to three insertions before the row
                costs = [min(costs[s], INSERT + costs[_NEXT[s]]) for s in range(4)]
            least = min(costs)
            found = self.before[c, after] = least, tuple(x - least for x in costs)
        return found

    def _walk(self, c: str, after: tuple, state: int) -> tuple[str, int]:
        """The first letters, in ASCII order, of cheapest edits of the row and the insertions before it, and the state after."""
        found = self.walked.get((c, after, state))
        if found is None:
            letters, at = "", state
            while True:
                least, costs = self._before(c, after)
                left = costs[at] + least
                ways = [("I", INSERT + least + costs[_NEXT[at]], _NEXT[at], False)] + [(x, cost + after[then], then, True) for x, cost, then in self._choices(c, at)]
                letter, _, at, done = min(w for w in ways if w[1] == left)
                letters += letter
                if done:
                    break
            found = self.walked[c, after, state] = letters, at
        return found

    def solve(self, signature: str) -> tuple[int, str]:
        """(cost, audit)."""
        after, total, steps = _END, 0, []
        for c in reversed(signature):
            steps.append(after)
            least, after = self._before(c, after)
            total += least
        state, letters = EMPTY, []
        cost = total + after[EMPTY]
        for c in signature:
            some, state = self._walk(c, steps.pop(), state)
            letters.append(some)
        letters.append("I" * (_END[state] // INSERT))
        return cost, "".join(letters)


def illegal_pairs(signature: str) -> int:
    """Adjacent rows whose initials are not su, ua or au."""
    initials = [_INITIAL[c] for c in signature]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows by the crc32 of conv_id:turn modulo 20. 0: no copy is left; 1: no text; 2: no . ! or ?;
    3: two copies; 4: role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat_ws(":", part("conv_id"), part("turn")), "utf-8")) % 20
    text, role = part("text"), part("role")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


_KEY = ["conv_id", "turn", "role", "d1", "d2"]
_WHITE = " \t\n\x0b\x0c\r"


def _digested(rows: DataFrame) -> DataFrame:
    """rows with d1 and d2, the text's digest of 128 bits."""
    return rows.withColumns({"d1": F.xxhash64(F.lit(1), F.col("text")), "d2": F.xxhash64(F.lit(2), F.col("text"))})


def _same(names: list[str], other: str) -> Column:
    out = F.lit(True)
    for c in names:
        out = out & F.col(f"rows.{c}").eqNullSafe(F.col(f"{other}.{c}"))
    return out


def _faults(rows: DataFrame) -> DataFrame:
    """A row a (conversation, turn, role, digest), without its text: copies, blank and whether the text's end is cut, and whether it is the
    first of its role and digest in the conversation."""
    bare = F.btrim("text", F.lit(_WHITE))
    small = _digested(rows).select(*_KEY, "copies", (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    small = small.groupBy(*_KEY).agg(F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    there = small.where("copies > 0")
    # Nulls are least in a struct, as turns are in order.
    firsts = there.groupBy("conv_id", "role", "d1", "d2").agg(F.min(F.struct("turn")).alias("first"))
    joined = small.alias("rows").join(firsts.alias("firsts"), _same(["conv_id", "role", "d1", "d2"], "firsts"), "left")
    return joined.select("rows.*", F.coalesce(F.col("firsts.first.turn").eqNullSafe(F.col("rows.turn")), F.lit(False)).alias("is_first"))


def _counted(faults: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated of every conversation, also of those without rows after damage."""
    there = F.col("copies") > 0
    turn = F.when(there, F.col("turn"))
    first = F.col("is_first").cast("long")
    said = there & ~F.col("blank")
    return faults.groupBy("conv_id").agg(
        F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(said, F.col("copies") - first).otherwise(0)).alias("duplicate"),
        F.sum(F.when(said & F.col("cut"), first).otherwise(0)).alias("truncated"),
    )


def _pieces(faults: DataFrame) -> DataFrame:
    """conv_id, at, piece: the signature of each conversation in pieces, in the order of at."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    gone = F.translate(initial, "".join(_GONE), "".join(_GONE.values()))
    first = F.when(F.col("blank") | ~F.col("is_first"), gone).when(F.col("cut"), F.upper(initial)).otherwise(initial)
    chars = F.concat(first, F.repeat(gone, (F.col("copies") - 1).cast("int")))
    ordered = faults.where("copies > 0").select(*_KEY, chars.alias("chars")).repartitionByRange(*[F.col(c).asc_nulls_first() for c in _KEY]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in _KEY])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, gone = np.asarray(batch.column(0).fill_null(0)), np.asarray(batch.column(0).is_null())
            begins = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (gone[1:] != gone[:-1])])
            chars, ends = batch.column(5).to_pylist(), [*begins.tolist()[1:], batch.num_rows]
            pieces = ["".join(chars[a:b]) for a, b in zip(begins.tolist(), ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(begins)) for i in range(5)] + [pa.array(pieces, pa.string())], names=[*_KEY, "piece"])

    found = ordered.mapInArrow(run, "conv_id long, turn long, role string, d1 long, d2 long, piece string")
    return found.select("conv_id", F.struct(*_KEY[1:]).alias("at"), "piece")


def signatures(faults: DataFrame) -> DataFrame:
    """conv_id, signature of every conversation that has rows."""
    parts = F.array_sort(F.collect_list(F.struct("at", "piece")))
    return _pieces(faults).groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias("signature"))


def solutions(distinct: DataFrame) -> DataFrame:
    """signature, illegal, cost, audit of each row of distinct (signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [solver.solve(s) for s in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([illegal_pairs(s) for s in texts], pa.int64()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.string())], names=["signature", "illegal", "cost", "audit"])

    return distinct.select("signature").mapInArrow(run, "signature string, illegal long, cost long, audit string")


class _Replay:
    """The repaired text of one conversation, hashed as its rows come by."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.any = audit, 0, EMPTY, hashlib.sha256(), False

    def _put(self, line: str) -> None:
        self.digest.update((("\n" if self.any else "") + line).encode())
        self.any = True

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(f"{_WANTED[self.state]}:")
            self.state, self.at = _NEXT[self.state], self.at + 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self._put(f"{role}:{text}")
            self.state = _fits(role[:1], self.state)
        elif letter == "R":
            self._put(f"{_WANTED[self.state]}:{text}")
            self.state = _NEXT[self.state]

    def done(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def _replayed(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: a conversation's audit comes before its rows in one sorted stream."""
    audits = solved.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("d1", "long"), ("d2", "long"))], F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    texts = _digested(rows.where("copies > 0")).select("conv_id", F.lit(1).alias("kind"), *_KEY[1:], "text", "copies")
    order = ["conv_id", "kind", *_KEY[1:]]
    stream = audits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, conv, ids, digests = None, None, [], []
        for batch in batches:
            for conv_id, kind, role, text, copies in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if kind == 0:
                    if current is not None:
                        ids.append(conv)
                        digests.append(current.done())
                    current, conv = _Replay(text), conv_id
                else:
                    for _ in range(copies):
                        current.row(role, text)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])
            ids, digests = [], []
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([current.done()], pa.string())], names=["conv_id", "repaired_sha256"])

    return stream.select("conv_id", "kind", "role", "text", "copies").mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of rows (conv_id, turn, role,
    text, copies, where 0 copies mean that only the conversation's name is left)."""
    bounded_batches(rows.sparkSession)
    faults = materialise(_faults(rows))
    signed = materialise(signatures(faults))
    solved = solutions(signed.select("signature").distinct())
    audits = signed.join(solved, "signature").select("conv_id", "illegal", "cost", "audit")
    none = {"illegal": F.lit(0).cast("long"), "cost": F.lit(0).cast("long"), "audit": F.lit("")}
    counted = _counted(faults)
    known = counted.alias("rows").join(audits.alias("audits"), _same(["conv_id"], "audits"), "left")
    known = materialise(known.select("rows.*", *[F.coalesce(F.col(f"audits.{c}"), v).alias(c) for c, v in none.items()]))
    ends = _replayed(rows, known)
    return known.alias("rows").join(ends.alias("ends"), _same(["conv_id"], "ends")).select("rows.*", "ends.repaired_sha256")
