import random

import pytest

from tests.llm.helpers import collect, docs
from tidewash.llm.sentencepiece_codec import BPE, MODEL_PATH, UNIGRAM, Codec, Model, build, decode, encode

TEXTS = ["Hello world", "  two  spaces   three ", "", "naïve café ☕ 漢字", "a\nb\tc\r\n", "▁ literal mark", "x" * 5000,
         "tab\tand ", " ", "🎉🎉 0x00 \x00 <s> </s> <unk> <0x0A>", "aaaa" * 40 + " " * 37 + "end", "ſ ŉ ﬁ"]


@pytest.fixture(scope="module")
def codec():
    with open(MODEL_PATH, "rb") as f:
        return Codec(f.read())


def random_texts(n):
    rng = random.Random(4)
    return ["".join(rng.choice("abcdeé  \n漢▁{}\r;.0") for _ in range(rng.randint(0, 200))) for _ in range(n)]


def test_parity_on_whole_texts(codec):
    import numpy as np

    for text in TEXTS + random_texts(300):
        want = codec.reference.encode(text)
        (ids, parity), = codec.encode([text])
        assert np.frombuffer(ids, "<i4").tolist() == want and parity
        assert codec.whole.encode(text, add_special_tokens=False).ids == want


def test_decode_round_trip(codec):
    import numpy as np

    for text in TEXTS + random_texts(200):
        (ids, _), = codec.encode([text])
        assert codec.read_back(text, ids) == (True, "▁" not in text)
        ids = np.frombuffer(ids, "<i4").tolist()
        assert codec.decode(ids) == text.replace("▁", " ")
        assert codec.decode(ids) == codec.reference.decode(ids)


def test_small_cache_gives_the_same(codec):
    with open(MODEL_PATH, "rb") as f:
        small = Codec(f.read(), cache_bytes=700)
    texts = TEXTS + random_texts(60)
    assert [small.encode([t])[0] for t in texts] == [codec.encode([t])[0] for t in texts]
    assert len(small.young) + len(small.old) <= 200


def test_frequent_chunks_stay_and_long_ones_are_not_kept(codec):
    with open(MODEL_PATH, "rb") as f:
        small = Codec(f.read(), cache_bytes=250_000)
    learnt, learn = [], small.learn
    small.learn = lambda new: (learnt.extend(new), learn(new))[1]
    for i in range(400):
        small.encode([f"the same words and{i} one{i} more{i}"])
        assert small.held <= 250_000
    assert learnt.count("▁same") == 1 and len(small.young) + len(small.old) < 2100
    small.encode(["漢字" * 5000])
    assert max(map(len, [*small.young, *small.old])) <= 64


def test_other_operators_drop_what_is_held(codec):
    from tidewash.llm import common, sentencepiece_codec as sp

    with open(MODEL_PATH, "rb") as f:
        assert sp._codec(f.read(), 2) and sp._CODECS
    list(common.frees(lambda: iter([1]))())
    assert not sp._CODECS and not common._HELD


def test_model_file_is_parsed(codec):
    m = codec.model
    assert (m.kind, m.byte_fallback, len(m.pieces), m.dummy_prefix, m.remove_extra_spaces) == (BPE, True, 32000, True, False)
    assert [p for p, _, _ in m.pieces[:3]] == ["<unk>", "<s>", "</s>"]
    assert m.splittable() and not Model(pieces=[("a▁b", 0.0, 1)]).splittable()


def test_unigram_scores_and_byte_fallback():
    pieces = [("<unk>", 0.0, 2)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + [
        ("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.0, 1), ("ab", -4.0, 1), ("▁ab", -7.5, 1)]
    whole = build(Model(pieces=pieces, kind=UNIGRAM, byte_fallback=True, remove_extra_spaces=True))
    out = whole.encode("ab  ab é", add_special_tokens=False)
    assert out.tokens == ["▁", "ab", "▁", "ab", "▁", "<0xC3>", "<0xA9>"]
    assert whole.decode(out.ids) == "ab ab é"


def test_frames(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, TEXTS[3])]
    out = encode(docs(spark, rows, clash=True), "doc_id", "text").cache()
    got = collect(out)
    assert len(got) == len(rows) and all(r["parity"] for r in got) and all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert [r["ids"] for r in got if r["id"] is None] == [[]]
    texts = dict(rows)
    assert all(r["round_trip"] and r["literal"] == ("▁" not in (texts[r["id"]] or "")) for r in got)
    back = {r["id"]: r["text"] for r in collect(decode(out, "id", "ids"))}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in rows)


def test_empty_table(spark):
    assert collect(encode(docs(spark, []), "doc_id", "text")) == []
