import math
import random
import re

from pyspark.sql import functions as F

from tests.llm.helpers import collect
from tidewash.llm import chat_format as C

NAMES = ["type", "text", "ref", "width", "height", "seconds", "pages"]
CONTROLS = [C.START, C.BODY, C.END, "<|image 0.0|>", "\\", "\\s", "\\l", "<", "|>", "<|", "a<", "|b", "\n", "é𝄞", ""]


def part(**values):
    return {n: values.get(n) for n in NAMES}


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, f"conv long, t int, role string, content array<{C.PART}>")
    if clash:
        df = df.withColumns({c: F.lit("x") for c in ("id", "nth", "parts", "turn", "formatted", "start", "loss", "all")})
    return df.repartition(3)


def formatted(spark, rows, **named):
    out = C.format_conversations(frame(spark, rows, named.pop("clash", False)), "conv", "t", "role", "content", **named)
    return {r["id"]: r for r in collect(out.select(
        "*", C.read_turns(F.col("formatted")).alias("read"), C.read_loss(F.col("formatted"), F.col("turns")).alias("learnt")))}


def random_rows(seed, convs=25):
    r, rows = random.Random(seed), []
    for conv in range(convs):
        for t in range(r.randrange(1, 7)):
            content = []
            for _ in range(r.randrange(5)):
                content.append(r.choice([
                    part(type="text", text="".join(r.choices(CONTROLS, k=r.randrange(6)))), part(type=None, text="bare text"),
                    part(type="image", ref="i.png", width=r.choice([None, -1, 29, 500]), height=28), part(type="document", ref="d", pages=3),
                    part(type="audio", ref="s.wav", seconds=0.5), part(type="video", ref="v"), part(type="text")]))
            rows.append((conv, t, r.choice(["user", "assistant", "system<|", "", None]), content))
    return rows


def tokens_of(p):
    if p["type"] in (None, "text"):
        return len(re.findall(r"[^\x20\x09-\x0D]+", p["text"] or ""))
    if p["type"] == "image":
        return math.prod(math.ceil(max(p[s] or 0, 0) / 28) for s in ("width", "height"))
    return {"audio": math.ceil((p["seconds"] or 0) * 25), "document": (p["pages"] or 0) * 1024}.get(p["type"], 0)


def test_round_trip_mask_and_attachments(spark):
    rows = random_rows(1)
    out = formatted(spark, rows, clash=True)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        got = out[conv]
        is_text = lambda p: p["type"] in (None, "text")
        texts = ["".join(p["text"] or "" for p in r[3] if is_text(p)) for r in mine]
        assert [tuple(t) for t in got["read"]] == [(r[2] or "", t) for r, t in zip(mine, texts)]
        assert got["learnt"] == "".join(t for r, t in zip(mine, texts) if r[2] == "assistant")
        assert [(a["turn"], a["part"], a["type"], a["ref"], a["tokens"]) for a in got["attachments"]] == [
            (i, j, p["type"], p["ref"], tokens_of(p)) for i, r in enumerate(mine) for j, p in enumerate(r[3]) if not is_text(p)]
        assert got["n_tokens"] == sum(tokens_of(p) for r in mine for p in r[3]) and got["n_turns"] == len(mine)
        # placeholders stand in order and nothing else looks like one
        assert re.findall(r"<\|(\w+) (\d+)\.(\d+)\|>", got["formatted"]) == [
            ("file" if a["type"] == "video" else a["type"], str(a["turn"]), str(a["part"])) for a in got["attachments"]]
        # spans, from the start of their turn, cover nothing but shown text of trained turns
        under = [got["formatted"][t["start"] + s["start"]:t["start"] + s["start"] + s["length"]] for t in got["turns"] for s in t["loss"]]
        assert not any("<" in u for u in under)
        assert "".join(u.replace("\\l", "<").replace("\\s", "\\") for u in under) == got["learnt"]


def test_nulls_ties_and_empty_content(spark):
    rows = [(None, None, None, None), (None, 2, "assistant", []), (7, None, "user", [part(type="text", text="x")]),
            (7, None, "user", [part(type="text", text="x")]), (7, 1, "assistant", [None, part(type="text", text=None)])]
    out = formatted(spark, rows)
    assert [tuple(t) for t in out[None]["read"]] == [("", ""), ("assistant", "")]
    assert [tuple(t) for t in out[7]["read"]] == [("user", "x"), ("user", "x"), ("assistant", "")]
    assert out[7]["learnt"] == "" and out[7]["attachments"] == []


def test_long_conversation_and_text(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", [part(type="text", text=f"{t}<é ")]) for t in range(4000)]
    rows.append((2, 0, "assistant", [part(type="text", text="<\\" * 200_000)]))
    out = formatted(spark, rows)
    assert out[1]["learnt"] == "".join(f"{t}<é " for t in range(1, 4000, 2)) and out[1]["n_turns"] == 4000
    assert out[2]["learnt"] == "<\\" * 200_000


def test_own_visitor_and_trained_roles(spark):
    class Counted(C.PartVisitor):
        def text(self, p):
            return F.lit(None).cast("string"), F.char_length(p["text"])

    rows = [(1, 0, "user", [part(type="text", text="q q"), part(type="image", width=14, height=15)])]
    out = formatted(spark, rows, trained=("user",), visitor=Counted(patch=14))
    assert out[1]["learnt"] == "q q" and out[1]["n_tokens"] == 3 + 2


def test_empty_table(spark):
    assert formatted(spark, []) == {}


def test_no_python_in_the_plan(spark):
    from tidewash.llm.queries import QUERIES

    plan = QUERIES["op13_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_query_against_brute_force(spark):
    import hashlib

    from tidewash.llm.queries import QUERIES, TRICKY

    by = {-7: [(0, "user", TRICKY), (1, "assistant", TRICKY)]}
    for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["conv_id"]: r for r in collect(QUERIES["op13_chat_format"](spark, "/root/testdata/sf0.001"))}
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        learnt = "".join(t for _, role, t in turns if role == "assistant")
        assert got[conv]["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (got[conv]["n_turns"], got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(turns), len(learnt), sha(learnt))
