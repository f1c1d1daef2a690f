"""Operator 12, conversation structure repair: the cheapest edits by iterative-deepening A*.

A conversation is well formed if its role initials read ``(s?(ua)+)?``.  Each row is kept
(0), given another role (3) or deleted (4, required for blank and duplicate rows), and empty
rows may be inserted anywhere (3); a truncated row that stays costs 3 more.  The audit is
the string of the edits' initials; of the cheapest the ASCII-least one wins.

The search goes depth first in ASCII edit order (D, I, K, R) under a cost bound that rises
to the least cost beyond it; the first accepting path is the answer.  The transposition
table keeps, for every failed (row, role state), the cost that it is proven to need at
least, across bounds.  Its first values come from an admissible estimate: disjoint pairs of
neighbouring rows that cannot both stay need an edit of their own.

Long conversations: in a run of rows whose roles alternate well, every cheapest path keeps
the rows in the middle (being out of step costs more than stepping back in), so the state
there is known and the search before it can be ended.  ``ENOUGH`` gives the rule.  A task
thus holds the rows since the last such place, not the conversation, which passes through
in order, sorted by Spark (and spilled where it is long).  Duplicates are found by a
window over (conversation, role, digest of the text).  The report's audit and digest are
built as rows pass; the audit has about one character a row and must fit in one cell.

Defined cases: rows go by (turn, role, text), nulls first; a null role or text is one
space; a null id is a conversation like any other; a role without a first character
cannot be kept; a conversation whose rows were all dropped has an empty repair; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewash.llm.common import frees

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3  # costs
CUT_SHORT = 3  # more for a truncated row that stays

#: Fixed values of the role states: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
WANTED = ("user", "user", "assistant", "user")  # the role that an inserted or reroled row gets
WHOLE = frozenset({0, 3})
LEGAL = frozenset({"su", "ua", "au"})

FINE, TRUNCATED, FORCED = 0, 1, 2  # kinds of rows; blank and duplicate rows are forced out

#: Leaving a run's rows unkept costs 3 (1 if truncated) a row more than keeping them; getting
#: into step before the run and out of it behind it costs 6 at most.  A row with more than 6 of
#: such cost on either side of it in its run, itself included, is kept by every cheapest path.
ENOUGH = 7
EXTRA = {FINE: 3, TRUNCATED: 1}


class Search:
    """The cheapest edits of ``rows``, (initial, kind) pairs, from a state to one of ``goals``."""

    def __init__(self, rows: list[tuple[str, int]], start: int, goals: frozenset[int]) -> None:
        self.rows, self.start, self.goals = rows, start, goals
        n = len(rows)
        # least cost of rows i.. whatever the state, and of the live row at or after i
        self.rest = [0] * (n + 2)
        self.live = [n] * (n + 1)
        self.forced = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            if rows[i][1] == FORCED:
                self.rest[i] = DELETE + self.rest[i + 1]
                self.live[i], self.forced[i] = self.live[i + 1], DELETE + self.forced[i + 1]
                continue
            self.live[i] = i
            j = self.live[i + 1]
            best = self._alone(i) + self.rest[i + 1]
            if j < n:
                if rows[i][0] + rows[j][0] not in LEGAL:
                    best = max(best, self.forced[i + 1] + self._pair(i, j) + self.rest[j + 1])
            elif goals == WHOLE and rows[i][0] != "a":
                best = max(best, self.forced[i + 1] + min(self._kept(i) + INSERT, self._changed(i)))
            self.rest[i] = best
        self.table: dict[tuple[int, int], int] = {}

    def _kept(self, i: int) -> int:
        initial, kind = self.rows[i]
        return (CUT_SHORT if kind else KEEP) if initial in ("s", "u", "a") else 1 << 30

    def _changed(self, i: int) -> int:
        return min(DELETE, REROLE + (CUT_SHORT if self.rows[i][1] else 0))

    def _alone(self, i: int) -> int:
        return min(self._kept(i), self._changed(i))

    def _pair(self, i: int, j: int) -> int:
        return min(self._kept(i) + self._kept(j) + INSERT, self._changed(i) + self._alone(j),
                   self._alone(i) + self._changed(j))

    def least(self, i: int, q: int) -> int:
        """A cost that no way from (row, state) to a goal goes below."""
        known = self.table.get((i, q))
        if known is not None:
            return known
        j = self.live[i]
        if j == len(self.rows):
            cost = self.rest[i] + (0 if q in self.goals else INSERT)
        else:
            cost = self.rest[i]
            if self.rows[j][0] not in STEP[q]:
                cost = max(cost, self.forced[i] + min(self._kept(j) + INSERT, self._changed(j)) + self.rest[j + 1])
        self.table[i, q] = cost
        return cost

    def edits(self, i: int, q: int) -> list[tuple[str, int, int, int]]:
        """(edit, cost, next row, next state) in ASCII order."""
        out = []
        here = self.rows[i] if i < len(self.rows) else None
        wanted = STEP[q][WANTED[q][0]]
        if here:
            out.append(("D", DELETE, i + 1, q))
        out.append(("I", INSERT, i, wanted))
        if here and here[1] != FORCED:
            more = CUT_SHORT if here[1] else 0
            if here[0] in STEP[q]:
                out.append(("K", KEEP + more, i + 1, STEP[q][here[0]]))
            out.append(("R", REROLE + more, i + 1, wanted))
        return out

    def run(self) -> tuple[int, str]:
        """(cost, audit)."""
        n = len(self.rows)
        while True:
            bound = self.least(0, self.start)
            path: list[str] = []
            stack = [[0, self.start, 0, iter(self.edits(0, self.start)), 1 << 30]]
            if n == 0 and self.start in self.goals:
                return 0, ""
            while stack:
                top = stack[-1]
                i, q, spent, left, needs = top
                for edit, cost, i2, q2 in left:
                    need = cost + self.least(i2, q2)
                    if spent + need > bound:
                        top[4] = min(top[4], need)
                        continue
                    path.append(edit)
                    if i2 == n and q2 in self.goals:
                        return spent + cost, "".join(path)
                    stack.append([i2, q2, spent + cost, iter(self.edits(i2, q2)), 1 << 30])
                    break
                else:  # failed: it is proven to need more than was left
                    self.table[i, q] = max(self.table.get((i, q), 0), top[4])
                    stack.pop()
                    if stack:
                        path.pop()
                        above = stack[-1]
                        cost = spent - above[2]
                        above[4] = min(above[4], cost + self.table[i, q])


class Repair:
    """Takes a conversation's rows in order; gives (edit, row or None, role) as soon as they are settled."""

    MEMO = 1 << 14  # searches remembered by the rows' initials and kinds
    SHORT = 32

    def __init__(self, memo: dict) -> None:
        self.memo = memo
        self.rows: list[tuple[str, int]] = []
        self.held: list = []
        self.state, self.cost = 0, 0
        self.run: list[tuple[int, int]] = []  # (index in rows, extra) of the live rows of the run so far
        self.before = 0  # extra of the run's rows that were settled

    def add(self, initial: str, kind: int, row) -> Iterator[tuple]:
        self.rows.append((initial, kind))
        self.held.append(row)
        if kind == FORCED:
            return
        last = self.run[-1][2] if self.run else None
        if last is None or last + initial not in LEGAL or "s" in (last, initial):
            self.run, self.before = [], 0
        if initial not in ("u", "a"):
            return
        self.run.append((len(self.rows) - 1, EXTRA[kind], initial))
        yield from self._settle()

    def _settle(self) -> Iterator[tuple]:
        """End the search behind the last row of the run that is surely kept."""
        ahead, at = 0, len(self.run) - 1
        while at >= 0:
            ahead += self.run[at][1]
            if ahead >= ENOUGH:
                break
            at -= 1
        if at < 0 or self.before + sum(e for _, e, _ in self.run[:at + 1]) < ENOUGH:
            return
        index, _, initial = self.run[at]
        goal = 2 if initial == "u" else 3
        yield from self._solve(index + 1, frozenset({goal}))
        self.before += sum(e for _, e, _ in self.run[:at + 1])
        self.run = [(i - index - 1, e, c) for i, e, c in self.run[at + 1:]]

    def end(self) -> Iterator[tuple]:
        yield from self._solve(len(self.rows), WHOLE)

    def _solve(self, n: int, goals: frozenset[int]) -> Iterator[tuple]:
        rows = self.rows[:n]
        key = (tuple(rows), self.state, goals) if n <= self.SHORT else None
        found = self.memo.get(key) if key else None
        if found is None:
            found = Search(rows, self.state, goals).run()
            if key:
                if len(self.memo) >= self.MEMO:
                    self.memo.clear()
                self.memo[key] = found
        cost, audit = found
        self.cost += cost
        q, i = self.state, 0
        for edit in audit:
            if edit == "K":
                q = STEP[q][rows[i][0]]
                yield edit, self.held[i], None
            elif edit == "D":
                yield edit, self.held[i], None
            else:
                role = WANTED[q]
                q = STEP[q][role[0]]
                yield edit, self.held[i] if edit == "R" else None, role
            i += edit != "I"
        self.state = q
        self.rows, self.held = self.rows[n:], self.held[n:]


_REPORT = ("id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
_EDITS = "id long, pos long, edit string, fault string, turn long, role string, text string"


class _Report:
    """One row a conversation: counts, cost, audit and the digest of the repaired rows."""

    def __init__(self, conv) -> None:
        self.conv, self.faults = conv, {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last = 0, None
        self.low = self.high = None
        self.turns = 0
        self.audit, self.sha, self.any = [], hashlib.sha256(), False

    def see(self, turn, initial, fault) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high or self.high is None
            self.high = turn
        if fault:
            self.faults[fault] += 1
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.last = initial

    def done(self, edits) -> Iterator[tuple]:
        for edit, row, role in edits:
            self.audit.append(edit)
            if edit == "D":
                continue
            line = f"{role or row[1]}:{row[2] if row else ''}"
            self.sha.update((("\n" if self.any else "") + line).encode())
            self.any = True
        return iter(())

    def close(self, cost) -> Iterator[tuple]:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        yield (self.conv, gaps, *self.faults.values(), self.illegal, cost, "".join(self.audit), self.sha.hexdigest())


class _Edits:
    """One row an edit, in order."""

    def __init__(self, conv) -> None:
        self.conv, self.pos = conv, 0

    def see(self, turn, initial, fault) -> None:
        pass

    def done(self, edits) -> Iterator[tuple]:
        for edit, row, role in edits:
            turn, old, text, fault = row or (None, None, "", None)
            yield self.conv, self.pos, edit, fault, turn, role or old, text
            self.pos += 1

    def close(self, cost) -> Iterator[tuple]:
        return iter(())


@frees
def _repaired(batches: Iterator[pa.RecordBatch], kind: type, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole conversations -> rows of ``kind``."""
    memo: dict = {}
    out: list[tuple] = []
    now, repair, sink = None, None, None

    def batch():
        columns = list(zip(*out)) or [[] for _ in schema]
        rows = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        out.clear()
        return rows

    def finish():
        out.extend(sink.done(repair.end()))
        out.extend(sink.close(repair.cost))

    for b in batches:
        size = 0
        columns = [b.column(n).to_pylist() for n in ("id", "turn", "role", "text", "fault")]
        for conv, turn, role, text, fault in zip(*columns):
            if repair is None or conv != now:
                if repair is not None:
                    finish()
                now, repair, sink = conv, Repair(memo), kind(conv)
            if role is None:  # the conversation's own row
                continue
            sink.see(turn, role[:1], fault)
            of = FINE if fault is None else TRUNCATED if fault == "truncated" else FORCED
            out.extend(sink.done(repair.add(role[:1], of, (turn, role, text, fault))))
            size += len(text)
            if len(out) >= 4096 or size >= 1 << 22 and out:
                yield batch()
                size = 0
        if out:
            yield batch()
    if repair is not None:
        finish()
        yield batch()


def faults(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str,
           present: str | None = None) -> DataFrame:
    """(id, turn, role, text, fault) of every row, and one row with a null role for every
    conversation in which some row is not ``present``."""
    blank_if_null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    there = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    base = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.when(there, F.col(turn_col).cast("long")).alias("turn"),
        F.when(there, blank_if_null(role_col)).alias("role"),
        F.when(there, blank_if_null(text_col)).alias("text"))
    seen = Window.partitionBy("id", "role", F.md5("text")).orderBy(F.col("turn").asc_nulls_first())
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    return base.withColumn("nth", F.row_number().over(seen)).select(
        "id", "turn", "role", "text",
        F.when(F.col("role").isNull(), None).when(trimmed == "", "blank").when(F.col("nth") > 1, "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated").alias("fault"))


def _run(rows: DataFrame, kind: type, columns: str, **named) -> DataFrame:
    order = [F.col(c).asc_nulls_first() for c in ("id", "turn", "role", "text")]
    schema = pa.schema([pa.field(*c.split()) for c in columns.replace(" long", " int64").split(", ")])
    checked = faults(rows, **named)
    sorted_rows = checked.repartition("id").sortWithinPartitions(
        *order, F.when(F.col("fault") == "duplicate", 1).otherwise(0))  # of equal rows the first is no copy
    return sorted_rows.mapInArrow(lambda b: _repaired(b, kind, schema), columns)


def repair_rows(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str,
                present: str | None = None) -> DataFrame:
    """(id, pos, edit, fault, turn, role, text): one row an edit, deletions too; the repaired
    conversation is those that are not D, by pos.  Rows for which the column ``present`` does not hold do not count."""
    return _run(rows, _Edits, _EDITS, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col, present=present)


def repair_report(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str,
                  present: str | None = None) -> DataFrame:
    """One row a conversation, also where no row is ``present``: gaps in the turns, rows by
    first fault, neighbours whose roles may not follow each other, cost and audit of the
    repair, and the digest of its lines ``role:text``."""
    return _run(rows, _Report, _REPORT, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col, present=present)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Fixed damage by crc32 of ``conv:turn`` modulo 20: 0 drops a row (``present`` false), 1
    empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes it the user's."""
    blank_if_null = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(blank_if_null(conv), F.lit(":"), blank_if_null(turn)).cast("binary")) % F.lit(20)
    rows = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), blank_if_null(role).alias("role"),
                       blank_if_null(text).alias("text"), how.alias("how"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("how") != 0).alias("present"), "how")
    copies = F.when(F.col("how") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", "present", F.explode(copies).alias("copy"))
