"""The registered queries against SQL, or against brute force where SQL can't tell."""

import re
import zlib

import numpy as np
import pytest
import xxhash
from comparison import difference, oracle_connection

from lexispan.llm.queries import QUERIES
from lexispan.llm.sql import ORACLES

SF_DIR = "/root/testdata/sf0.001"
SPACE = re.compile(rb"[\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def simhash(text):
    words = [w for w in SPACE.split((text or "").encode().lower()) if w]
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    value = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles)
        value |= (2 * ones > len(shingles)) << bit
    return value


def test_simhash_components(spark, con):
    texts = con.sql("SELECT doc_id, text FROM documents").fetchall()
    prints = {doc_id: simhash(text) for doc_id, text in texts}
    ids = sorted(prints)
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and least[b] < least[a]:
                    least[a], changed = least[b], True
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, SF_DIR).collect()}
    assert got == {i: (f"{prints[i]:016x}", least[i]) for i in ids}


def test_toxicity_on_held_out_labels(spark, con):
    labels = dict(con.sql("SELECT doc_id, toxic FROM labels").fetchall())
    rows = QUERIES["op2_toxicity"](spark, SF_DIR).collect()
    assert len(rows) == con.sql("SELECT count(*) FROM documents").fetchall()[0][0]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) > 0.85


def test_html_text_of_pages(spark, con):
    pages = dict(con.sql("SELECT page_id, html FROM pages").fetchall())
    rows = QUERIES["op7_html_text"](spark, SF_DIR).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        import html as entities
        parts = re.split(r"</?(?:h1|p|li|ul|br)[^>]*>", article)
        text = " ".join(" ".join(entities.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts)
        assert r.text == " ".join(text.split()) and r.n_chars == len(r.text)


def test_contamination_finds_whole_items(spark, con):
    rows = {r.doc_id: r for r in QUERIES["op8_decontaminate"](spark, SF_DIR).collect()}
    items = con.sql("SELECT item_id, text FROM benchmark").fetchall()
    texts = con.sql("SELECT doc_id, text FROM documents").fetchall()
    assert set(rows) == {d for d, _ in texts}
    holding = {d for d, t in texts if any(" ".join(i.lower().split()) in " ".join(t.lower().split()) for _, i in items)}
    assert holding and holding <= {d for d, r in rows.items() if r.contaminated}
    assert sum(r.contaminated for r in rows.values()) <= len(holding) + 2


def test_mixture_keeps_every_document(spark, con):
    rows = QUERIES["op3_source_mix"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == {d for d, in con.sql("SELECT doc_id FROM documents").fetchall()}
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
