"""WARC archives, URL filters and main text of pages."""

import hashlib
import time

import duckdb

import pytest
from pyspark.sql import functions as F

from lexispan.llm.html_text import extract, extract_pages
from lexispan.llm.shared import new_path
from lexispan.llm.sql import ORACLES
from lexispan.llm.url_filter import Rule, judge_urls, reputations
from lexispan.llm.warc import archive_round_trip, read_archives, write_archives

SCHEMA = "page_id long, url string, html string, digest string, host string, rule string"
LONG = "é" * 600


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", "h", "r") for r in rows], SCHEMA)


PAGES = [
    (1, "http://a.org/x", LONG), (2, "http://a.org/y", LONG), (3, None, LONG), (4, "http://b/\r\nz", "short"),
    (5, "http://b", "short"), (6, "http://c", None), (7, "http://d", ""), (None, "http://e", LONG),
    (8, "u", "x" * 300_000), (8, "u", "x" * 300_000), (9, "v", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
]


def test_round_trip(spark):
    found = archive_round_trip(pages(spark, PAGES).repartition(3)).collect()
    want = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        original = 3 if html == LONG and page in (1, 2) else None
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(),
                     "revisit" if original else "response", original))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert archive_round_trip(pages(spark, [])).collect() == []


def test_selected_records_are_read_whole(spark):
    folder = new_path(spark, "warc-test")
    index = write_archives(pages(spark, PAGES), folder)
    assert index.count() == len(PAGES)
    rows = read_archives(index, folder, F.col("page_id").isin(3, 4, 9)).collect()
    assert {r.page_id: (r.url, bytes(r.payload).decode()) for r in rows} == {
        3: (None, LONG), 4: ("http://b/%0D%0Az", "short"), 9: ("v", PAGES[-1][2])}


RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"),
         Rule("allow", "org/fr/"))


def test_rules_hosts_and_paths(spark):
    urls = {
        "http://A.Example.NET/en/x?q#f": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://fakeexample.com/de/": ("fakeexample.com", "/de/", None, "allow"),
        "https://m.example.com/de/1": ("m.example.com", "/de/1", "example.com/de/", "block"),
        "http://net": ("net", "", None, "allow"), "http://x.net?/": ("x.net", "", None, "allow"),
        "ÄB://É.org/fr/": ("É.org", "/fr/", "org/fr/", "allow"), "no scheme.net/": ("", "", None, "allow"),
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"),
    }
    frame = pages(spark, [(i, u, "") for i, u in enumerate(urls)])
    none = spark.createDataFrame([], "url string, bad int")
    got = judge_urls(frame, none, RULES)
    assert got.columns == ["page_id", "url", "html", "digest", "host", "path", "rule", "bound", "verdict"]
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == urls
    assert judge_urls(pages(spark, []), none, RULES).collect() == []


def test_reputation_shrinks_small_hosts_and_blocks_bad_ones(spark):
    outcomes = [("http://bad.com/", 1)] * 60 + [("http://good.com/", 0)] * 200 + [("http://one.com/", 1)]
    outcomes += [(f"http://h{i}.com/", (i + k) % 5 == 0) for i in range(60) for k in range(12)]
    outcomes += [(None, 1), ("x", 1), ("http://n.com", None)]
    frame = spark.createDataFrame([(u, None if b is None else int(b)) for u, b in outcomes], "url string, bad int")
    urls = ["http://bad.com/a", "http://good.com/a", "http://one.com/a", "http://new.com/"]
    got = {r.url: r for r in judge_urls(pages(spark, [(i, u, "") for i, u in enumerate(urls)]), frame).collect()}
    assert [got[u].verdict for u in urls] == ["block", "allow", "allow", "allow"]
    known = {r.host: r for r in reputations(
        spark.createDataFrame([("a.com", 1), ("a.com", 0), ("b.com", 1)], "host string, bad int")).collect()}
    assert all(r.a > 0 and r.b > 0 for r in known.values()) and set(known) == {"a.com", "b.com"}


ARTICLE = "".join(f"<p>Paragraph {i} has quite a few words in it, <b>bold</b> ones too.</p>" for i in range(6))
TEXT = " ".join(f"Paragraph {i} has quite a few words in it, bold ones too." for i in range(6))
AROUND = (
    '<nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav>'
    '<header><h2>Site name</h2></header><div id="cookie-notice">We use cookies to serve you better every day.</div>'
    '<div class="ad">Buy this now, it is very cheap and very good for you.</div>{}'
    '<aside><p>Elsewhere on this site you can read many other things.</p></aside>'
    '<form><label>Your name</label><textarea>text</textarea><button>Send</button></form>'
    '<section class="comments"><p>A reader says that all of this is wrong and more.</p></section>'
    '<script>var x = "<p>no</p>";</script><style>p {{ margin: 0 }}</style><noscript>Turn it on</noscript>'
    "<footer><p>&copy; Somebody, all rights reserved, in all countries.</p></footer>"
)


@pytest.mark.parametrize("wrapped", [
    "<article>{}</article>", "<main>{}</main>", '<div class="post">{}</div>', '<div role="main">{}</div>',
    "<div><section>{}</section></div>",
])
def test_main_text_without_its_surroundings(wrapped):
    page = f"<html><head><title>T</title></head><body>{AROUND.format(wrapped.format(ARTICLE))}</body></html>"
    assert extract(page) == TEXT


def test_short_blocks_references_and_broken_markup():
    assert extract("<article><h1>Title</h1><p>A long enough paragraph &amp; more &eacute;&#233;&nbsp;x.<p>Nd."
                   "<p>Another  one\n here<br>there.</article>") == (
        "Title A long enough paragraph & more éé x. Nd. Another one here there.")
    assert extract("<article><p><b>Bold is never closed.<p>Next.</p></article><footer>x</footer>") == (
        "Bold is never closed. Next.")
    assert extract("plain text") == "plain text"
    assert extract('<div class="header">Site</div><div class="post comments-open no-sidebar"><p>One of these.'
                   '<p>Two of these.</div>') == "One of these. Two of these."
    assert extract('<article><header><h1>Title</h1></header><p>Text of it.</p><div class="share-bar">Share</div>'
                   "</article>") == "Title Text of it."
    assert [extract(x) for x in (None, "", "<p></p>", "<", "</div></p>")] == [""] * 3 + ["<", ""]
    assert extract("<div>one line</div><!-- <p>b</p> --><div>a &lt;tag&gt;</div>") == "one line a <tag>"
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert extract(deep) == "x"


def test_pages_table(spark):
    rows = [(1, None, "<p>a</p>"), (None, "u", None), (1, None, "<p>a</p>"), (2, "v", "<p>" + "word " * 50_000)]
    got = sorted(map(tuple, extract_pages(pages(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, None, "a", 1), (None, "u", "", 0), (1, None, "a", 1),
                          (2, "v", ("word " * 50_000).strip(), 249_999)], key=repr)
    assert extract_pages(pages(spark, [])).collect() == []


def skewed_outcomes():
    """Hosts with subdomains; two hosts and their domain are bad, others of that suffix are not."""
    bad = {("blog.tionsh.example.com", 80): 76, ("m.tionsh.example.com", 40): 37, ("blog.good.org", 90): 3,
           ("m.good.org", 70): 2, ("www.other.com", 60): 6, ("blog.other.com", 50): 4, ("m.third.net", 3): 2,
           ("a.b.c.third.net", 30): 15, ("com", 4): 1}
    return [(host, int(k < n_bad)) for (host, n), n_bad in bad.items() for k in range(n)]


def test_reputations_shrink_towards_registered_domain_and_suffix(spark):
    rows = skewed_outcomes()
    frame = spark.createDataFrame(rows, "host string, bad int")
    got = {r.host: (r.a, r.b) for r in reputations(frame).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality BIGINT)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", [(i, f"http://{h}/") for i, (h, _) in enumerate(rows)])
    con.executemany("INSERT INTO labels VALUES (?, ?)", [(i, 1 - b) for i, (_, b) in enumerate(rows)])
    head = ORACLES["op6_url_filter"].split("SELECT u.page_id, u.host", 1)[0]
    want = {h: (a, b) for h, a, b in con.sql(head + "SELECT host, a, b FROM hm").fetchall()}
    assert got.keys() == want.keys()
    for host, pair in want.items():
        assert got[host] == pytest.approx(pair, rel=1e-6), host
    urls = con.sql("SELECT host, any_value(verdict) FROM (" + ORACLES["op6_url_filter"] + ") GROUP BY host").fetchall()
    outcomes = frame.selectExpr("concat('http://', host, '/') AS url", "bad")
    found = judge_urls(outcomes, outcomes, RULES).select("host", "verdict").distinct().collect()
    assert {(r.host, r.verdict) for r in found} == set(urls)
    assert {h for h, v in urls if v == "block"} >= {"blog.tionsh.example.com", "m.tionsh.example.com"}


def test_hosts_without_outcomes_are_judged_by_domain_and_suffix(spark):
    rows = [(f"http://h{i}.bad.com/", 1) for i in range(20) for _ in range(100)]
    rows += [(f"http://h{i}.good.com/", 0) for i in range(20) for _ in range(200)]
    rows += [(f"http://h{i}.d{k}.junk/", 1) for i in range(5) for k in range(20) for _ in range(40)]
    frame = spark.createDataFrame(rows, "url string, bad int")
    urls = {"http://new.bad.com/": "block", "http://bad.com/x": "block", "http://new.good.com/": "allow",
            "http://new.com/": "allow", "http://new.junk/": "block", "http://a.b.new.junk/": "block",
            "http://new.xyz/": "allow", "http://h1.bad.com/": "block", "no url": "allow"}
    got = judge_urls(pages(spark, [(i, u, "") for i, u in enumerate(urls)]), frame).collect()
    assert {r.url: r.verdict for r in got} == urls
    assert all((r.bound is None) == (r.host == "") for r in got)


LEAD = "The lead of the article has a good many words, too, and says what it is all about."
ITEMS = "".join(f"<li>Item {i} of the list is a rather long one and has many words in it, more than most.</li>" for i in range(12))
ITEM_TEXT = " ".join(f"Item {i} of the list is a rather long one and has many words in it, more than most." for i in range(12))
CELLS = ITEMS.replace("<li>", "<tr><td>").replace("</li>", "</td></tr>")
SPLIT = {
    f'<div id="page"><div class="lead"><p>{LEAD} {LEAD}</p></div><div class="body">{ARTICLE}</div></div>': f"{LEAD} {LEAD} {TEXT}",
    f'<div id="page"><h1>A heading</h1><p>{LEAD}</p><ul>{ITEMS}</ul></div>': f"A heading {LEAD} {ITEM_TEXT}",
    f'<div id="page"><h1>A heading</h1><p>Short.</p><ol>{ITEMS}</ol></div>': f"A heading Short. {ITEM_TEXT}",
    f'<div id="page"><h1>A heading</h1><p>Short.</p><table>{CELLS}</table></div>': f"A heading Short. {ITEM_TEXT}",
    f"<div><article><p>{LEAD}</p></article><article>{ARTICLE}</article></div>": f"{LEAD} {TEXT}",
    f"<article>{ARTICLE}</article><h2>Part two</h2><article><p>{LEAD}</p></article>": f"{TEXT} Part two {LEAD}",
    f'<div><article>{ARTICLE}</article><article class="related"><p>{LEAD}</p></article></div>': TEXT,
    f"<main><article><p>{LEAD}</p></article><article>{ARTICLE}</article></main><div><p>{LEAD}</p></div>": f"{LEAD} {TEXT}",
}


@pytest.mark.parametrize("parts", SPLIT)
def test_articles_of_several_parts_are_whole(parts):
    page = f"<html><head><title>T</title></head><body>{AROUND.format(parts)}</body></html>"
    assert extract(page) == SPLIT[parts]


@pytest.mark.parametrize("broken", [
    "<![foo[x]]>", "<![if !IE]>", "<![endif]>", "<!ELEMENT br EMPTY>", "<![CDATA[ <p>no</p> ]]>", "<![", "<!-", "<?php x ?>",
    "<!DOCTYPE html [<!ENTITY a 'b'>]>", "</>", "<a <b>", "&#xFFFFFFF;", "<![CDATA[",
])
def test_no_declaration_ends_the_job(broken):
    page = f"<article><p>First paragraph of the text.</p>{broken}<p>Second paragraph of the text.</p></article>"
    assert extract(page).startswith("First paragraph of the text.")
    extract(broken)


@pytest.mark.parametrize("tag", ["<div>", "<b>", "<p><i>", "<ul><li>", "<table><tr><td>"])
def test_deep_pages_take_linear_time(tag):
    start = time.perf_counter()
    text = extract(tag * (300_000 // len(tag)) + "<p>The end of a deep page.</p>")
    assert "The end of a deep page." in text and time.perf_counter() - start < 30


def test_reading_tasks_follow_the_bytes(spark, monkeypatch):
    from lexispan.llm import warc
    from lexispan.llm.shared import new_path

    pages = spark.createDataFrame([(i, f"http://a/{i}", f"{i} " * 900) for i in range(300)], "page_id long, url string, html string")
    folder = new_path(spark, "archives")
    index = warc.write_archives(pages.repartition(4), folder)
    monkeypatch.setattr(warc, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(warc, "TASK_BYTES", 3000)
    read = warc.read_archives(index, folder)
    assert read.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert sorted(r.page_id for r in read.select("page_id").collect()) == list(range(300))
