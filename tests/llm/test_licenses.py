"""Versions, variants and wrapped notices of licences."""

import textwrap

from monthgrain.llm import licenses


def test_versions_variants_and_wrapped_notices(documents):
    gpl = licenses.NOTICES["gpl-3.0"][1]
    texts = {
        "This work is licensed under the GNU General Public License, version 2.": "gpl-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0",
        "Licensed under CC BY 4.0.": "cc-by-4.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
        "Licensed under CC BY 2.5.": "",
        "Licensed under the Mozilla Public License, Version 1.1.": "",
        "Released under the MIT License.": "mit",
        "Prose of its own.\n\n" + textwrap.fill(gpl, 60) + "\n\nMore prose of its own.": "gpl-3.0",
        textwrap.fill(gpl.replace("version 3", "version 2"), 60): "gpl-2.0",
        textwrap.fill(licenses.NOTICES["mit"][2], 40): "mit",
    }
    docs = documents(*texts)
    model = licenses.train(docs.selectExpr("text"), others=50)
    rows = {r.doc_id: r for r in licenses.scan(docs, model).collect()}
    got = {t: rows[k].families for k, t in enumerate(texts)}
    assert got == texts
    assert [rows[k].confirmed for k in (5, 6, 8)] == [False, False, True]
    assert rows[8].family == "gpl-3.0" and rows[8].n_notices >= 1


def test_whole_paragraphs_are_learnt(documents, monkeypatch):
    seen = []
    monkeypatch.setattr(licenses, "_margin", lambda m, g: seen.append(set(g)) or [0.0] * 99)
    docs = documents(*[f"{'x ' * 300}{k} software {k}" for k in range(60)])
    licenses.train(docs.selectExpr("text"), others=60)
    assert {"software"} in seen


def test_only_grams_with_a_listed_beginning_are_made(spark):
    listed = ["a", "a b", "b c d", "x y z"]
    rows = spark.sql(
        "SELECT split(s, ' ') AS words FROM VALUES ('a b c d a b'), ('x y'), ('q'), ('b c d'), "
        "('z x y z a') AS t(s)"
    )
    among = licenses._grams_among(listed)
    plain = f"filter({licenses.ALL_GRAMS}, g -> g IN ({licenses._literals(listed)}))"
    found = rows.selectExpr(f"{among} AS found", f"{plain} AS want").collect()
    assert all(r.found == r.want for r in found)
    assert found[0].found == ["a", "a b", "b c d"]
