"""Main texts of pages against what each page is made from."""

import html
import re

import pytest

from monthgrain.llm import pages
from monthgrain.llm.queries import QUERIES

P = "<p>A paragraph, of some length, that says a few things and ends here.</p>"
SAID = "A paragraph, of some length, that says a few things and ends here."

CASES = [
    ("", ""),
    ("only text &amp; no tags", "only text & no tags"),
    ("<p>", ""),
    ("<article><h1>T</h1><p>a<p>b&nbsp;c <b>d</b>e<br>f</article><footer>no</footer>", "T\na\nb c de f"),
    # menus, headers, notices, forms and comments inside and outside
    (
        f"<body><header>Site</header><nav><a href=x>m</a></nav><article>{P}<aside>no</aside>"
        f"<div class='ad-slot'>no</div><form><p>no</p></form><div id=comments>{P * 3}</div></article>"
        f"<div class='cookie-notice'>{P}</div><script>var x = '<p>no</p>'</script>",
        SAID,
    ),
    # no article: the container of the paragraphs, its title beside it, not the menu
    (
        "<div><ul><li><a href=a>Home of all</a></li><li><a href=b>News</a></li></ul></div>"
        f"<div><h1>Title</h1><div>{P * 2}</div></div><div>&copy; someone</div>",
        f"Title\n{SAID}\n{SAID}",
    ),
    # paragraphs in sections of one article
    (f"<article><section>{P * 5}</section><section><p>Short.</p></section></article>",
     "\n".join([SAID] * 5 + ["Short."])),
    # a form or a header around it all, which some systems write
    (f"<form class=page><input value=x><article>{P}</article></form>", SAID),
    (f"<header><h1>Site</h1><article>{P}</article>", f"{SAID}"),
    (f"<div class='has sidebar'><main>{P}</main></div>", SAID),
    # a reader's comment is no article
    (f"<article>{P}</article><article class=comment>{P * 4}</article>", SAID),
    # lists, tables and quotes are text; lists of links are menus
    ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table><blockquote>q, r</blockquote>"
     "<ul><li><a>a</a><li><a>b</a><li><a>c</a></ul></article>", "one\ntwo\nx\ny\nq, r"),
    # text before and after an inner block
    ("<article><div>before<p>inside</p>after</div></article>", "before\ninside\nafter"),
    # broken markup
    (f"<article>{P}<!-- never closed", SAID),
    (f"<article>{P}<a href='never closed", SAID),
    ("<article><p>1 < 2 &lt; 3 &#x41;&#66; &unknown; a</b></p></i>", "1 < 2 < 3 AB &unknown; a"),
    (f"<article>{P}<script>never closed <p>x</p>", SAID),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_cases(page, text):
    assert pages.main_text(page) == text


@pytest.mark.parametrize("unit", ["<div>", "<b><p>", "</div></p>", "<", "<!--", "<a b='", "<li><i>"])
def test_time_is_linear(unit):
    assert isinstance(pages.main_text(unit * 20_000 + "x"), str)


def test_whole_table(spark):
    """Every page of the tables has an article of headline and paragraphs."""
    folder = "/root/testdata/sf0.01"
    given = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op11_pages"](spark, folder)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == len(given)
    for row in rows:
        inner = re.search("<article>(.*)</article>", given[row.page_id], re.S)[1]
        plain = html.unescape(re.sub("<[^>]*>", "", re.sub("</?(p|h1|br)>", "\n", inner)))
        lines = (" ".join(line.split()) for line in plain.split("\n"))
        assert row.text == "\n".join(line for line in lines if line)
        assert row.n_chars == len(row.text)


def test_odd_rows(spark):
    kinds = "page_id long, url string, html string, Text int, n_chars string"
    page = (1, None, CASES[3][0], 1, "x")
    rows = spark.createDataFrame([page, page, (None, "u", None, 2, None)], kinds)
    found = pages.extract(rows)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.text for r in found.collect()) == ["", CASES[3][1], CASES[3][1]]
    assert pages.extract(rows.where("false")).collect() == []
