"""Feeds with faults: what lies before and after a fault comes out."""

import pytest

from siftmill.sources import feeds


@pytest.fixture(scope="module")
def scan(spark):
    def run(*documents, **more):
        df = spark.createDataFrame([(i, *(d if isinstance(d, tuple) else (d, "https://a.test/dir/feed.xml"))) for i, d in enumerate(documents)], "i int, xml string, base string")
        return [tuple(r) for r in feeds.feed_table(df, **more).orderBy("i", "n").select("i", "format", "title", "link", "published", "description", "error").collect()]

    return run


def test_rss(scan):
    a = """junk <?xml version="1.0"?><!DOCTYPE rss><rss version="2.0" xmlns:d="http://purl.org/dc/elements/1.1/"><channel><title>C</title>
    <item><title><![CDATA[One & <b>two</b>]]></title><link> /p?a=1&amp;b=2 </link><d:date>2026-01-02</d:date><description>&lt;p&gt;Said &amp;amp; done&lt;/p&gt;</description></item>
    <!-- <item><title>hidden</title></item> --><item><title/><dc:title>Own</dc:title><guid isPermaLink="false">x</guid><feedburner:origLink>http://b.test/q</feedburner:origLink><link>http://c.test</link></item>
    <item><title>Guid</title><guid>https://g.test/1</guid><pubDate> </pubDate><updated>U</updated><description>x &lt;time datetime="2026-02-03"&gt;</description></item>
    <item><title>Time</title><atom:link rel="self" href="/s"/><atom:link href="/t"/><description>&amp;lt;time datetime="2026-02-03"&amp;gt; &amp;lt;b&amp;gt;deep&amp;lt;/b&amp;gt;</description></item></channel></rss>"""
    assert scan(a) == [
        (0, "rss", "One & two", "https://a.test/p?a=1&b=2", "2026-01-02", "Said & done", None), (0, "rss", "Own", "http://b.test/q", None, "", None),
        (0, "rss", "Guid", "https://g.test/1", "U", "x", None), (0, "rss", "Time", "https://a.test/t", "2026-02-03", "deep", None),
    ]


def test_faults(scan):
    broken = "<rss><channel><item><title>A & B</title><link>/1</link><description>never <b>closed</item><item><title>Next<link>/2</link></title></item><item><title>Open</title><link>/3</link><item><title>After</title><link>/4</link></item></chan"
    got = scan(broken)
    assert [r[2:4] for r in got if r[-1] is None] == [("A & B", "https://a.test/1"), ("Next /2", None), ("Open", "https://a.test/3"), ("After", "https://a.test/4")]
    assert got[0] == (0, "rss", None, None, None, None, "not in order") and got[1][5] == "never closed"
    assert scan("<html>no</html>", None, "", "<rss></rss>", ("<rss><channel><item><link>rel</link></item></channel></rss>", None)) == [(0, None, None, None, None, None, "no feed"), (1, None, None, None, None, None, "no feed"), (2, None, None, None, None, None, "no feed"), (4, "rss", "", None, None, "", None)]


def test_atom(scan):
    a = """<a:feed xmlns:a="http://www.w3.org/2005/Atom" xml:base="https://x.test/b/"><a:title>F</a:title><a:entry xml:base="c/"><a:source><a:title>Other</a:title><a:link href="https://o.test"/></a:source><a:title>T</a:title>
    <a:link rel="self" href="s"/><a:link rel="alternate" type="application/json" href="j"/><a:link rel="alternate" type="text/html" href="h"/><a:updated>2</a:updated><a:published>1</a:published></a:entry>
    <a:entry><a:title>U</a:title><a:link rel="enclosure" href="e"/><a:link rel="related" href="r"/><a:summary type="html">&lt;i&gt;s&lt;/i&gt;</a:summary></a:entry><a:entry><a:id>https://x.test/id</a:id></a:entry><a:entry><a:id>tag:x</a:id><a:link href="javascript:x"/></a:entry></a:feed>"""
    assert scan(a) == [
        (0, "atom", "T", "https://x.test/b/c/h", "1", "", None), (0, "atom", "U", "https://x.test/b/r", None, "s", None), (0, "atom", "", "https://x.test/id", None, "", None), (0, "atom", "", None, None, "", None),
    ]


def test_rdf_and_metadata(scan):
    rdf = '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"><channel><title>C</title></channel><item rdf:about="https://r.test/1"><title>R</title></item></rdf:RDF>'
    drupal = "<rss><channel><item><description>&lt;div class=\"f field--name-title\"&gt;&lt;div&gt;T&lt;/div&gt;&lt;/div&gt; rest</description></item></channel></rss>"
    got = scan(rdf, drupal, metadata=r"field--name-(?:title|created)(?![\w-])")
    assert got[0][:4] == (0, "rdf", "R", "https://r.test/1") and got[1][5] == "rest"
    assert scan(drupal)[0][5] == "T rest"


def test_candidates(spark):
    many = "<rss><channel>" + "".join(f"<item><title>Title {i}</title><link>/{i}</link><pubDate>Tue, 03 Mar 2026 10:00:00 GMT</pubDate><description>Title {i}: a b c d</description></item>" for i in range(3000)) + "</channel></rss>"
    out = feeds.feed_candidates(spark.createDataFrame([("f", many, "https://a.test")], "feed string, xml string, base string"), words=3)
    assert out.count() == 3000
    r = out.where("n = 7").first()
    assert (r["feed"], r["title"], r["link"], r["lead"], r["date_status"], str(r["ts"])) == ("f", "Title 7", "https://a.test/7", "a b c…", "ok", "2026-03-03 10:00:00")
