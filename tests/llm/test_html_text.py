import html
import re

import pytest
from pyspark.sql import Row

from cellframe.llm import html_text
from cellframe.llm.shared import table

SF_DIR = "/root/testdata/sf0.01"


def article(source: str) -> str:
    inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_given_pages(spark):
    want = {r.page_id: article(r.html) for r in table(spark, SF_DIR, "pages").collect()}
    rows = html_text.query(spark, SF_DIR).collect()
    assert {r.page_id: r.text for r in rows} == want
    assert all(r.n_chars == len(r.text) for r in rows)


@pytest.mark.parametrize("source, text", [
    ("<p>a<b>c</b> d</p>text<div>z<script>x < y</script>", "ac d\ntext\nz"),
    ("<div class='page sidebar-left'><nav>m</nav><div class=cookie-banner>c</div><article class=post><p>a &amp; b<p>c"
     "<ul><li>x<li>y</ul><div class=comments><p>no</p></div></article><aside>q</aside></div>", "a & b\nc\nx\ny"),
    ("<main><h1>T</h1><p>one\n two&nbsp;three<br>four</p></main><footer>f</footer>", "T\none two three four"),
    ("<article><p>a<!-- no --><form>no</form></article><article><p>b", "a\nb"),
    ("<table><tr><td>1<td>2<tr><td>3</table>x < y &lt; &#122; &#x41;", "1\n2\n3\nx < y < z A"),
    ("<p title='a > b' class=\"x\">kept</p></div></p><style>p{}", "kept"),
    ("<div role=navigation>no</div><div id=userComments>no</div>yes", "yes"),
    ("plain", "plain"), ("", ""), ("<", "<"), ("<p", ""), ("a<!--", "a"), ("<script>", ""),
])
def test_one_page(source, text):
    assert html_text.Page(source).text(set()) == text


def test_templates_of_a_site_go_and_short_sentences_stay(spark):
    bar = "<div><span>Follow us everywhere</span></div>"
    pages = [Row(page_id=i, url=f"http://a.org/{i}", html=f"{bar}<div><p>Only here {i}.</p><p>Yes.</p></div>") for i in range(6)]
    # copies of one page make no template, nor does what is on two pages of another host
    pages += [Row(page_id=10 + i, url=f"http://b.org/{i}", html="<div><p>The same text.</p></div>") for i in range(9)]
    pages += [Row(page_id=30 + i, url=f"http://c.org/{i}", html=f"{bar}<p>{i}</p>") for i in range(2)]
    # in an article, paragraphs stay and a box on every page goes
    pages += [Row(page_id=40 + i, url=f"http://d.org/{i}", html=f"<article><div>{bar}</div><p>Yes.</p><p>{i}</p></article>")
              for i in range(6)]
    df = spark.createDataFrame(pages)
    for rows in (html_text.extract(df), html_text.extract(df, broadcast_rows=0)):
        got = {r.page_id: r.text for r in rows.collect()}
        assert got[12] == "The same text." and got[30] == "Follow us everywhere\n0"
        assert got[40] == "Yes.\n0" and got[3] == "Only here 3."


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, host string, n_chars long"
    rows = [(1, None, None, "x", "y", 1), (2, "nowhere", "", "x", "y", 1), (None, "http://a.b/", "<p>t", "x", "y", 1),
            (3, "http://a.b/", "<p>" + "long " * 50_000, "x", "y", 1), (3, "http://a.b/", "<div>" * 3_000 + "deep", "x", "y", 1)]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.page_id or 0, len(r.text), r.n_chars) for r in html_text.extract(df).collect())
    assert got == [(0, 1, 1), (1, 0, 0), (2, 0, 0), (3, 4, 4), (3, 249_999, 249_999)]
    assert html_text.extract(df.limit(0)).isEmpty()


def test_counts_decide_around_and_inside_articles(spark):
    own = "A sentence of the page's own that is longer than what stands beside it, number {}."
    teaser = "<article><h3>More</h3><p>Read the teaser {}.</p></article>"
    house = "<p>All rights to this text remain with the publisher of the journal.</p>"
    pages = [Row(page_id=i, url=f"http://a.org/{i}", html=f"<div><p>{own.format(i)}</p></div>{teaser.format(i)}") for i in range(6)]
    pages += [Row(page_id=10 + i, url=f"http://b.org/{i}", html=f"<article><p>{own.format(i)}</p><p>Yes.</p>{house}</article>")
              for i in range(6)]
    df = spark.createDataFrame(pages)
    for rows in (html_text.extract(df), html_text.extract(df, broadcast_rows=0)):
        got = {r.page_id: r.text for r in rows.collect()}
        assert got[2] == f"{own.format(2)}\nRead the teaser 2."  # the teaser is not the page
        assert got[12] == f"{own.format(2)}\nYes."  # a long paragraph of all pages goes, a short one stays


def test_a_section_of_a_large_host_loses_its_box(spark):
    box = "<div><span>This box stands on every page of one section of the site.</span></div>"
    pages = [Row(page_id=i, url=f"http://a.org/{i}", html=f"{box if i < 4 else ''}<div><p>Page {i}.</p>{'<p>Yes.</p>' if i < 4 else ''}</div>")
             for i in range(60)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages)).collect()}
    assert got[1] == "Page 1.\nYes." and got[50] == "Page 50."
