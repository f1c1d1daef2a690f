"""Inputs that are long or deep in one direction, within seconds."""

import random
import re
import time

from pyspark.sql import functions as F

from tidewash.llm import html_extract as H
from tidewash.llm.language_id import visible_text
from tidewash.llm.license_scan import spdx_ids

HIDDEN = re.compile(r"(?is)<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>|<[^>]*>")


def test_visible_text_equals_the_pattern():
    r = random.Random(2)
    marks = ["<!--", "-->", "<script", "<SCRIPT>", "</script >", "</style>", "<style a=1>", "<b>", "<", ">", "x", " ", "&amp;", "</template>",
             "<template>", "<scripts>", "--", "<!", "é\n"]
    for _ in range(3000):
        page = "".join(r.choices(marks, k=r.randrange(25)))
        assert visible_text(page) == visible_text(HIDDEN.sub(" ", page).replace("<", "&lt;")) or "<" in HIDDEN.sub("", page)
        import html as entities

        assert visible_text(page) == entities.unescape(HIDDEN.sub(" ", page)), page


def test_markup_that_never_ends_is_quick():
    start = time.time()
    for piece in ("<!--", "<script", "<script>", "<!-- x >", "<style>a", "<"):
        visible_text(piece * (1_000_000 // len(piece)))
    assert time.time() - start < 20


def test_nested_elements():
    start = time.time()
    found = H.blocks("<div>a " * 50_000)
    assert len(found) == 50_000 and len(found[-1][2]) == 50_000
    slots = H.features(found)
    assert len(slots) == 50_000 and slots[-1][:8] != slots[0][:8]
    H.blocks("<div>a " * 20_000 + "</p></nothing>" * 50_000)
    assert time.time() - start < 20


def test_shared_paths_give_the_features_of_plain_ones():
    html = """<body><nav class="siteNav-main"><ul><li>One<li>Two</ul></nav><div id="content"><article><p>Text <b>bold</b></p>
    <div class="commentlist"><p>Reply</p></div></article></div>"""
    found = H.blocks(html)
    plain = [(t, k, tuple(p)) for t, k, p in found]
    assert H.features(found) == H.features(plain) and [p[-1][0] for _, _, p in plain] == ["li", "li", "p", "p"]


def test_pages_without_any_label(spark):
    body = "".join(f"<p>This is sentence {i} of a long report about the harbour and its boats, as told by the fishermen.</p>" for i in range(6))
    page = f"""<html><body><div class="nav menu"><ul><li><a href=a>Home</a><li><a href=b>Shop</a></ul></div>
    <div class="article-body">{body}</div><div class="footer copyright"><p>© Us</p></div></body></html>"""
    df = spark.createDataFrame([(1, "u", page), (2, "v", None)], "page_id long, url string, html string")
    got = {r.id: r.text for r in H.extract(df, "page_id", "url", "html").collect()}
    assert got[1].split("\n") == [f"This is sentence {i} of a long report about the harbour and its boats, as told by the fishermen." for i in range(6)]
    assert got[2] == ""


def old_ids(text):
    one = r"\(*[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?\)*"
    out = []
    for line in re.findall(rf"(?i:SPDX-License-Identifier):[ \t]*({one}(?:[ \t]+(?:(?i:AND|OR|WITH))[ \t]+{one})*)", text):
        line = re.sub(r"(?i)[ \t]+WITH[ \t]+[^ \t]+", "", line)
        out += [re.sub(r"(?i)(-only|-or-later|\+)$", "", x) for x in re.split(r"(?i)[ \t]+(?:AND|OR)[ \t]+", re.sub("[()]", "", line))]
    return out


def test_spdx_lines(spark):
    r = random.Random(3)
    words = ["MIT", "GPL-2.0-only", "(Apache-2.0", "BSD-3-Clause)", "AND", "or", "WITH", "Classpath-exception-2.0", "ISC.", "*/", "-->",
             "LGPL-2.1+", "\n", "\r\n", "", "MIT,", "and"]
    texts = ["x SPDX-License-Identifier: " + r.choice([" ", "\t", ""]).join(["", *[w + " " for w in r.choices(words, k=r.randrange(9))]])
             + r.choice(["", "\nspdx-license-identifier: MIT", " x SPDX-License-Identifier: ISC"]) for _ in range(400)]
    texts += ["", "no line", "SPDX-License-Identifier:", "SPDX-License-Identifier: MIT OR Apache-2.0 WITH LLVM-exception AND ISC"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", spdx_ids(F.col("t")).alias("ids")).collect()
    for row in rows:
        assert row.ids == old_ids(row.t), row.t


def test_an_spdx_line_of_a_hundred_thousand_ids(spark):
    df = spark.createDataFrame([("SPDX-License-Identifier: " + " OR ".join(["MIT"] * 100_000),)], "t string")
    assert df.select(F.size(spdx_ids(F.col("t")))).first()[0] == 100_000
