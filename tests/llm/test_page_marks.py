"""What class, id and role marks decide on a page, and what they leave to the neighbours."""

import pytest

from riskframe.llm.html_extract import TEXT, UNDECIDED, main_texts, text_lines


@pytest.mark.parametrize("page, lines", [
    ('<nav>m</nav><article class="post has-sidebar"><p>a</p></article><footer>f</footer>', ["a"]),
    ('<div class="with-sidebar"><article><p>a</p></article><div class="sidebar">x</div></div>', ["a"]),
    ('<div class="widget"><main><p>a</p></main></div>', ["a"]),
    ('<article><h2 id="search-algorithms">h</h2><section id="social-history">s</section><p id="related-work">r</p></article>', ["h", "s", "r"]),
    ('<article><p>E = <math><mi>m</mi><mo>c</mo></math> end</p><p class="ad">buy</p><div class="comments">c</div></article>', ["E = mc end"]),
    ('<article>t</article><div id="comments"><article class="comment">c</article></div>', ["t"]),
    ('<main><p>t</p><div id="comments">c</div><aside>x</aside><form>y</form></main>', ["t"]),
    ('<div id="search-page"><article>t</article></div>', ["t"]),
])
def test_text_that_marks_decide(page, lines):
    found = text_lines(page)
    assert [x for x, fate in found if fate == TEXT] == lines
    assert not [x for x, fate in found if fate == UNDECIDED]


def test_a_part_of_a_name_decides_nothing():
    assert text_lines('<article><div class="article-header">h</div><p>t</p></article>') == [("h", UNDECIDED), ("t", TEXT)]
    assert text_lines('<h1 id="legal">L</h1><div id="copyright-law">c</div>') == [("L", UNDECIDED), ("c", UNDECIDED)]


def test_undecided_lines_of_marked_pages_go_if_a_neighbour_has_them(spark):
    page = ('<article><div class="article-header">{}</div><p>text of page {} and nothing else</p>'
            '<div class="post-share">Share this on the usual places</div></article>')
    rows = [(k, f"http://a.com/x/{k:03d}", page.format(f"title {k}", k)) for k in range(40)]
    got = {r.page_id: (r.text, r.n_shared) for r in main_texts(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got == {k: (f"title {k}\n\ntext of page {k} and nothing else", 1) for k in range(40)}
    one = main_texts(spark.createDataFrame(rows[:1], "page_id int, url string, html string")).first()
    assert one.text.endswith("Share this on the usual places")  # nobody shares it
