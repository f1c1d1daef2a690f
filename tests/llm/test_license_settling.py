"""Competing templates: the license that a text names, and no sibling's."""

from tests.llm.helpers import collect, docs
from tidewash.llm.license_scan import TEMPLATES, licenses

GPL2, GPL3 = (f"This work is licensed under the GNU General Public License, version {v}." for v in (2, 3))
HEADER = ("This program is free software{}; you can redistribute it and/or modify it under the terms of the GNU {}General"
          " Public License as published by the Free Software Foundation, either version {} of the License, or (at your"
          " option) any later version.")
NOISE = "the river and the old town are in this picture of a house "
MORE = [*TEMPLATES, ("GPL-2.0", HEADER.format("", "", 2)), ("AGPL-3.0", HEADER.format("", "Affero ", 3))]


def found(spark, texts, templates=None):
    out = collect(licenses(docs(spark, list(enumerate(texts))), "doc_id", "text", templates))
    assert all(r["licenses"] == sorted({m["license"] for m in r["matches"]}) for r in out)
    return [r["licenses"] for r in sorted(out, key=lambda r: r["id"])]


def test_lines_that_differ_in_one_word(spark):
    texts = [GPL3, GPL2, NOISE * 9 + GPL3 + NOISE * 9, f"{GPL2} {GPL3}", f"{GPL3} {GPL2}", NOISE.join([GPL3] * 40 + [GPL2] + [GPL3] * 3),
             NOISE.join([GPL3] * 40), GPL3.replace("version 3", "version 1"), GPL3.replace("This work", "My work")]
    assert found(spark, texts) == [["GPL-3.0"], ["GPL-2.0"], ["GPL-3.0"], ["GPL-2.0", "GPL-3.0"], ["GPL-2.0", "GPL-3.0"],
                                   ["GPL-2.0", "GPL-3.0"], ["GPL-3.0"], [], ["GPL-3.0"]]


def test_headers_that_differ_in_one_word(spark):
    texts = [HEADER.format(":", "", 3), HEADER.format("", "", 2), HEADER.format(":", "Affero ", 3),
             HEADER.format("", "", 2) + NOISE + HEADER.format(":", "Affero ", 3)]
    assert found(spark, texts, MORE) == [["GPL-3.0"], ["GPL-2.0"], ["AGPL-3.0"], ["AGPL-3.0", "GPL-2.0"]]


def test_template_inside_another(spark):
    short = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    both = [("Short", short), ("Long", short + " and some more words")]
    assert found(spark, [short, short + " and some more words", short + " and none", f"{short} . {short} and some more words"],
                 both) == [["Short"], ["Long"], ["Short"], ["Long", "Short"]]


def test_licenses_without_a_rival_all_stay(spark):
    texts = [t for _, t in TEMPLATES] + [" ".join(t for _, t in TEMPLATES), None, ""]
    assert found(spark, texts) == [[n] for n, _ in TEMPLATES] + [sorted({n for n, _ in TEMPLATES}), [], []]
