import html
import re

from pyspark.sql import functions as F

from pitwall.llm import templates as H


def from_markup(page):
    """The article of the test pages, read straight from their known markup."""
    if "<article>" not in (page or ""):
        return ""
    inner = page.split("<article>", 1)[1].split("</article>")[0]
    found = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", inner)]
    return "\n\n".join(x for x in found if x)


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: from_markup(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert got == want and all(want.values())


def page(i, extra="", body=""):
    return (f"<html><head><title>T{i}</title><script>if (a<b) x('</p>')</script></head><body><div id=top class='site menu'>Home | Shop {i}</div>"
            f"<div class=box><div><h2>Story {i} &amp; more&nbsp;of it</h2><p>First   part {i}<p>Second <b>bold</b>part {i}<br>line {extra}</div>"
            f"<div class='user-comments'><p>I like {i}</p></div></div>{body}<form>Name {i}</form><footer>c {i}</footer></body></html>")


def test_template_without_article_tag(spark):
    rows = [(i, f"http://a.org/{i}", page(i, body="<div>Share this now</div>")) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == f"Story {i} & more of it\n\nFirst part {i}\n\nSecond boldpart {i} line"
    found = H.templates(spark.createDataFrame([("a", i, p) for i, _, p in rows], "host string, page long, html string")).collect()
    assert found[0]["main"] == "/html/body"  # its inner elements stand more than once on a page
    assert len(found[0]["texts"]) == 1


def test_copies_keep_their_text(spark):
    rows = [(i, "http://a.org/same", page(7)) for i in range(30)] + [(100, "http://b.org/", page(1))]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[i] for i in range(30)} == {"Story 7 & more of it\n\nFirst part 7\n\nSecond boldpart 7 line"}
    assert got[100].startswith("Story 1 ")


def test_odd_rows(spark):
    long = "<article>" + "<p>word &lt; word</p>" * 30_000 + "</article>"
    rows = [(1, None, None), (2, "", ""), (None, "http://x.org", "<p>a<!-- b"), (3, "http://x.org", long), (3, "http://x.org", long),
            (4, "http://y.org", "a < b & c &copy <unclosed"), (5, None, "<div><div></p></b><li>x<li>y</ul>"), (6, "http://z.org", "<script>var x"),
            (7, "http://q.org", "<title>only</title><nav>m</nav>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("main", F.lit("m")).withColumn("text", F.lit("t"))
    got = [(r["page_id"], r["text"]) for r in H.extract(pages).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    assert by[1] == by[2] == by[6] == by[7] == "" and by[None] == "a" and by[5] == "x\n\ny"
    assert by[3] == "\n\n".join(["word < word"] * 30_000) and by[4].startswith("a < b & c ©")
    assert H.extract(pages.limit(0)).count() == 0


def test_text_beside_the_body_stays(spark):
    body = "long body text "
    rows = [(i, f"http://a.org/{i}", f"<html><body><article><h1>Title {i}</h1><p>Lead {i}</p><div><p>{body * 9}{i}</p></div><p>End {i}</p></article>"
             "<div>Same on all pages</div></body></html>") for i in range(12)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i}\n\nLead {i}\n\n{body * 9}{i}\n\nEnd {i}" for i in range(12))


def test_marks_on_what_holds_the_article(spark):
    rows = [(i, f"http://a.org/{i}", f"<html><body class='single has-sidebar'><div class='content no-comments'><div class='post share-enabled'><h1>Title {i}</h1>"
             f"<svg width=1 /><p>Part {'long ' * 20}{i}</p></div><div class=comments>I like {i}</div></div><div class=sidebar>Side {i}</div></body></html>") for i in range(12)]
    rows += [(100, "http://b.org/", "<p>One<svg viewBox='0 0 1 1'/> two</p><iframe src=x><p>three</p>")]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title {i}\n\nPart {'long ' * 20}{i}" for i in range(12))
    assert got[100] == "One two\n\nthree"


def test_template_texts_are_those_of_its_classes(spark):
    """A line of the article on 24 of 25 pages is in no class with an element; a note in its own element is."""
    rows = [(i, f"http://a.org/{i}", f"<html><body><article><h1>Title {i}</h1><p>Part {i}</p>{'<p>So much for today.</p>' if i != 3 else '<p>More soon.</p>'}</article>"
             + ("<section><b>All rights reserved</b></section>" if i != 5 else "") + "<div>Same on all pages</div></body></html>") for i in range(25)]
    got = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Title {i}\n\nPart {i}\n\n" + ("More soon." if i == 3 else "So much for today.") for i in range(25)}
