import hashlib
import random

import pytest

from tests.llm.helpers import collect, docs
from tidewash.llm.suffix_dedup import matched_windows, remove_repeats, segments


def brute(rows, length, keep):
    """{row number: (kept bytes, spans)} straight from the definition."""
    texts = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    places = {}
    for i in order:
        for p in range(len(texts[i]) - length + 1):
            places.setdefault(texts[i][p:p + length], []).append((i, p))
    cover = [bytearray(len(t)) for t in texts]
    for where in places.values():
        for i, p in where[1:] if keep == "first" else where if len(where) > 1 else ():
            cover[i][p:p + length] = b"\1" * length
    out = {}
    for i, (t, c) in enumerate(zip(texts, cover)):
        spans, p = [], 0
        while p < len(c):
            if c[p]:
                q = p
                while q < len(c) and c[q]:
                    q += 1
                spans.append((p, q))
                p = q
            p += 1
        out[i] = (bytes(b for b, x in zip(t, c) if not x), spans)
    return out


def found(spark, rows, length, keep, **more):
    out = collect(remove_repeats(docs(spark, rows, clash=True), "doc_id", "text", length=length, keep=keep, **more))
    return sorted(((r["id"], r["n_bytes"], bytes(r["kept"]), [(s["low"], s["high"]) for s in r["spans"]]) for r in out), key=repr)


def expected(rows, length, keep):
    b = brute(rows, length, keep)
    return sorted(((rows[i][0], len((rows[i][1] or "").encode()), *b[i]) for i in range(len(rows))), key=repr)


def corpus(seed, n=60, alphabet="abé"):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [word(rng.randint(18, 70)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [word(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 10)
            parts += [p[a:], word(rng.randint(0, 12))]
        rows.append((i * 3, "".join(parts)))
    return rows + [(1, None), (4, ""), (7, "a" * 120), (8, rows[0][1]), (10, rows[0][1]), (None, passages[0] + "zz")]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group", [1, 2048])
def test_against_brute_force(spark, keep, group):
    rows = corpus(3)
    assert found(spark, rows, 20, keep, gram=6, group=group) == expected(rows, 20, keep)


def test_wide_alphabet_and_other_gram(spark):
    rows = corpus(5, 40, "abcdefghijklmnopqrstuvwxyz ")
    assert found(spark, rows, 16, "none", gram=12) == expected(rows, 16, "none")


def test_repeated_rows_and_passage_inside_one_text(spark):
    rows = [(5, "same text that is long enough to match"), (5, "same text that is long enough to match"),
            (6, "abcdefghijklmnopqrstuvwxyz" + "0123" + "abcdefghijklmnopqrstuvwxyz")]
    assert found(spark, rows, 20, "none", gram=6) == expected(rows, 20, "none")
    first = found(spark, rows[2:], 20, "first", gram=6)
    assert first[0][2] == b"abcdefghijklmnopqrstuvwxyz0123"


def test_empty_table(spark):
    assert found(spark, [], 20, "none") == []


def test_long_text_in_pieces(monkeypatch):
    import numpy as np

    from tidewash.llm import suffix_dedup as s

    monkeypatch.setattr(s, "BLOCK_BYTES", 1000)
    data = np.random.default_rng(1).integers(97, 122, 5000).astype(np.uint8)
    windows = []
    for piece, bounds, text, at in s._pieces(data, np.array([0, 5000]), 50):
        x = segments(piece, bounds, 50, 10)
        windows += [at + w for a, b in zip(x["low"], x["high"]) for w in range(a, b - 49)]
    assert sorted(windows) == list(range(4951))


def test_matched_windows_tells_earlier_from_later():
    body, window, earlier, later = matched_windows([b"0123456789abcdefgh", b"xx0123456789abyy"], 10)
    assert set(zip(body.tolist(), window.tolist(), earlier.tolist(), later.tolist())) == (
        {(0, w, False, True) for w in range(3)} | {(1, w + 2, True, False) for w in range(3)})


def test_query_on_whole_table(spark):
    from tidewash.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = brute(rows, 400, "none")
    got = {r["doc_id"]: r for r in collect(QUERIES["op4_suffix_array_dedup"](spark, "/root/testdata/sf0.001"))}
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(rows):
        kept, spans = want[i]
        r = got[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(t.encode()), len(t.encode()) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
