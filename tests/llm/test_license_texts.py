"""The whole catalogue: every license is found in its own text, and no sibling's is."""

from pathlib import Path

import pytest

from tests.llm.test_license_settling import HEADER, NOISE, found
from tidewash.llm import license_texts
from tidewash.llm.queries import QUERIES

BODIES = sorted((Path(license_texts.__file__).parent / "licenses").glob("*.txt"))


@pytest.fixture(scope="module")
def templates():
    return license_texts.catalogue()


def test_every_template_gives_its_own_id_only(spark, templates):
    got = found(spark, [f"{NOISE * 3} {t} {NOISE * 3}" for _, t in templates], templates)
    assert [(n, g) for (n, _), g in zip(templates, got) if g != [n]] == []
    assert len(BODIES) >= 25 and len({n for n, _ in templates}) >= 50


def test_bodies_with_changes(spark, templates):
    """Another holder's name, upper case, and every hundredth word changed."""
    texts = []
    for p in BODIES:
        words = p.read_text().upper().split()
        texts.append(" ".join("changed" if i % 100 == 99 else w for i, w in enumerate(words)))
    assert [(p.stem, g) for p, g in zip(BODIES, found(spark, texts, templates)) if g != [p.stem]] == []


def test_several_licenses_in_one_text(spark, templates):
    body = {p.stem: p.read_text() for p in BODIES}
    texts = [body["BSD-2-Clause"] + NOISE + body["BSD-3-Clause"], body["MIT-0"] + NOISE + body["MIT"] + body["ISC"],
             body["GPL-2.0"] + HEADER.format("", "", 2) + NOISE * 5 + HEADER.format(":", "Affero ", 3)]
    assert found(spark, texts, templates) == [["BSD-2-Clause", "BSD-3-Clause"], ["ISC", "MIT", "MIT-0"], ["AGPL-3.0", "GPL-2.0"]]


def test_spdx_lines(spark):
    from tests.llm.helpers import collect, docs
    from tidewash.llm.license_scan import licenses

    texts = ["// SPDX-License-Identifier: MIT\nint x;", "# spdx-license-identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR Apache-2.0.",
             "SPDX-License-Identifier: AGPL-3.0-or-later Some prose. SPDX-License-Identifier: LGPL-2.1+", "SPDX-License-Identifier:", None]
    out = sorted(collect(licenses(docs(spark, list(enumerate(texts))), "doc_id", "text")), key=lambda r: r["id"])
    assert [r["licenses"] for r in out] == [["MIT"], ["Apache-2.0", "GPL-2.0"], ["AGPL-3.0", "LGPL-2.1"], [], []]


def test_query_has_the_whole_catalogue(spark, tmp_path):
    rows = [(k, p.read_text()) for k, p in enumerate(BODIES)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.licenses for r in QUERIES["op6_license_scan"](spark, str(tmp_path)).collect()}
    assert got == {k: [p.stem] for k, p in enumerate(BODIES)}
