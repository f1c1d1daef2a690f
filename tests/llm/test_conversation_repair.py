import hashlib
import random
import re
import zlib

import pytest

from tests.llm.helpers import collect
from tidewash.llm.conversation_repair import (
    FINE, FORCED, TRUNCATED, WHOLE, Repair, Search, damaged, repair_report, repair_rows)

SCHEMA = "conv_id long, turn long, role string, text string"
STEPS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """All states row by row: the least (cost, audit, roles) of each; rows are (role, kind, text)."""
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(4):
            new = dict(best)
            for q, (c, a, out) in best.items():
                r = "assistant" if q == "u" else "user"
                way = (c + 3, a + "I", out + ((r, ""),))
                q2 = STEPS[q, r[0]]
                if q2 not in new or way[:2] < new[q2][:2]:
                    new[q2] = way
            best = new
        return best

    for role, kind, text in rows:
        new = {}
        for q, (c, a, out) in inserted(best).items():
            ways = [(q, (c + 4, a + "D", out))]
            if kind != FORCED:
                more = 3 if kind == TRUNCATED else 0
                if (q, role[:1]) in STEPS:
                    ways.append((STEPS[q, role[:1]], (c + more, a + "K", out + ((role, text),))))
                for r in ("user", "assistant"):
                    if (q, r[0]) in STEPS:
                        ways.append((STEPS[q, r[0]], (c + 3 + more, a + "R", out + ((r, text),))))
            for q2, way in ways:
                if q2 not in new or way[:2] < new[q2][:2]:
                    new[q2] = way
        best = new
    return min((w for q, w in inserted(best).items() if q in ("", "a")), key=lambda w: w[:2])


def repaired(rows):
    repair, edits = Repair({}), []
    for role, kind, text in rows:
        edits += repair.add(role[:1], kind, (role, text))
    edits += repair.end()
    lines = [(new or row[0], row[1] if row else "") for e, row, new in edits if e != "D"]
    return repair.cost, "".join(e for e, _, _ in edits), tuple(lines)


NAMES = {"u": "user", "a": "assistant", "s": "system", "x": "xenon", "": ""}


@pytest.mark.parametrize("seed", range(8))
def test_search_and_cuts_against_all_states(seed):
    r = random.Random(seed)
    for _ in range(400):
        n = r.choice([0, 1, 2, 3, 5, 9, 20, 45])
        odd = r.choice([0.05, 0.2, 0.9])
        rows, role = [], "s" if r.random() < 0.3 else "u"
        for i in range(n):
            rows.append((NAMES[role if r.random() > odd else r.choice(["u", "a", "s", "x", ""])],
                         r.choices([FINE, TRUNCATED, FORCED], [1, r.choice([0, 0.2, 5]), odd])[0], f"t{i}"))
            role = {"s": "u", "u": "a", "a": "u"}[role]
        want = cheapest(rows)
        whole = Search([(role[:1], kind) for role, kind, _ in rows], 0, WHOLE)
        assert whole.run() == want[:2], rows
        assert repaired(rows) == want, rows
        text = "".join(role[0] for role, _ in want[2])
        assert re.fullmatch("(s?(ua)+)?", text)


def test_estimate_never_exceeds_the_cost():
    r = random.Random(5)
    for _ in range(300):
        rows = [(r.choice("uasx"), r.choice([FINE, TRUNCATED, FORCED])) for _ in range(r.randrange(9))]
        named = [(NAMES[i], k, "") for i, k in rows]
        assert Search(rows, 0, WHOLE).least(0, 0) <= cheapest(named)[0]


def test_long_conversation_holds_few_rows():
    r, repair, most = random.Random(1), Repair({}), 0
    for i in range(60_000):
        list(repair.add("ua"[i % 2] if r.random() > 0.1 else r.choice("uas"), r.choices([0, 1, 2], [8, 1, 1])[0], None))
        most = max(most, len(repair.rows))
    list(repair.end())
    assert most < 1000


def test_worst_case_without_any_run_ends():
    rows = [("u", i % 3 % 2) for i in range(3000)]
    cost, audit = Search(rows, 0, WHOLE).run()
    assert len(audit) >= 3000 and cost > 0


def brute(rows):
    """The contract in plain Python over (conv_id, turn, role, text) rows."""
    show = lambda x: " " if x is None else str(x)
    by = {}
    for conv, turn, role, text in rows:
        mine = by.setdefault(conv, [])
        role, text = show(role), show(text)
        how = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        mine += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    out = []
    for conv, mine in by.items():
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        count, seen, kinds = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in mine:
            chars = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not chars else "duplicate" if (role, text) in seen
                     else "truncated" if chars[-1] not in ".!?" else None)
            seen.add((role, text))
            kinds.append((role, FORCED if fault in ("blank", "duplicate") else TRUNCATED if fault else FINE, text))
            if fault:
                count[fault] += 1
        turns = {t for t, _, _ in mine if t is not None}
        cost, audit, lines = cheapest(kinds)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *count.values(),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:])),
                    cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def report(df):
    out = repair_report(damaged(df), "conv_id", "turn", "role", "text", present="present")
    return sorted((tuple(r.values()) for r in collect(out)), key=repr)


def frame(spark, rows, clash=False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    if clash:
        df = df.withColumns({c: F.lit("x") for c in ("id", "fault", "nth", "how", "copy", "present", "edit", "pos")})
    return df.repartition(3)


def spoken(r, conv, n):
    role, rows = "system" if r.random() < 0.3 else "user", []
    for t in range(n):
        rows.append((conv, t, role, r.choice(["Yes.", "no", "Well!\n ", " ", "é?", f"line {t}.", None, "x" * 30_000 + "."])))
        role = {"system": "user", "user": "assistant", "assistant": "user"}[role]
    return rows


def test_report_against_brute_force(spark):
    r = random.Random(3)
    rows = [row for conv in range(120) for row in spoken(r, conv, r.choice([1, 2, 5, 8, 40]))]
    rows += [(None, 1, "user", "a."), (None, None, None, None), (500, None, "user", "q."), (500, None, "user", "q."),
             (501, 3, "", "t."), (501, 3, "Usher", "t."), (502, 7, "user", " "), *[(503, 5, "user", "same.")] * 4]
    assert report(frame(spark, rows, clash=True)) == brute(rows)
    assert {0, 1, 2, 3, 4} <= {zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, _, _ in rows}


def test_one_conversation_of_most_rows(spark):
    r = random.Random(4)
    rows = spoken(r, 1, 6000) + [row for conv in range(2, 60) for row in spoken(r, conv, 4)]
    assert report(frame(spark, rows)) == brute(rows)


def test_edit_rows_give_the_same_repair(spark):
    r = random.Random(6)
    rows = [row for conv in range(40) for row in spoken(r, conv, 6)]
    d = damaged(frame(spark, rows))
    by = {}
    for e in sorted(collect(repair_rows(d, "conv_id", "turn", "role", "text", present="present")), key=lambda e: (e["id"], e["pos"])):
        by.setdefault(e["id"], []).append(e)
    for conv, *_, audit, sha in brute(rows):
        mine = by.get(conv, [])
        assert "".join(e["edit"] for e in mine) == audit
        lines = "\n".join(f"{e['role']}:{e['text']}" for e in mine if e["edit"] != "D")
        assert hashlib.sha256(lines.encode()).hexdigest() == sha


def test_empty_table(spark):
    assert report(frame(spark, [])) == []


def test_query_on_whole_table(spark):
    from tidewash.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.01").withColumnRenamed("conv_id", "id")
    assert sorted((tuple(r.values()) for r in collect(out)), key=repr) == brute(rows)
