"""The filter and source audits against direct counts on small hand-made tables."""

import itertools
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lexispan.llm.filter_audit import audit, coalition_values, failure_counts, potentials
from lexispan.llm.source_audit import source_divergence

LONG = " ".join(f"word{i}" for i in range(250))
DOCS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (3, LONG, "de"), (1, LONG, None), (None, LONG, "en"), (4, None, ""),
    (5, "", "en"), (6, "same same same same", "en"), (7, "SHOUT", "de"), (8, "a & b", None), (9, "x " * 300, "fr"),
    (10, LONG + " $", "en"), (11, LONG.upper(), "en"), (12, "é" * 100_000, "de"), (13, LONG + "\n" + LONG, "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (7, 0, 1), (99, 1, 1), (None, 1, 1), (10, 1, None)]


def fails(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = ""
        bad += "A" * (len(words) < 200)
        bad += "B" * (100 * len(set(words)) < 50 * len(words))
        bad += "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t))
        bad += "D" * bool(re.search("[#$%&*|]", t))
        bad += "E" * (i is not None and least[t] < i)
        yield i, lang or "", bad


def by_hand(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, lang, bad in fails(rows):
        parts[lang].append((i in good, i in toxic, bad))
    for part, own in parts.items():
        out = {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[2]]
                left = [d for d in left if letter not in d[2]]
                out[order, step] = [
                    len(left), len(gone), sum(letter in d[2] for d in own) - len(gone), sum(d[2] == letter for d in own),
                    sum(d[0] for d in gone), sum(d[1] for d in gone)]
        total = Counter()
        for (order, step), row in out.items():
            total[order[step - 1]] += row[1]
        for (order, step), row in out.items():
            yield (part, order, step, *row, total[order[step - 1]])


def test_filter_audit(spark):
    docs = spark.createDataFrame([(*r, 1, "x") for r in DOCS], "doc_id int, text string, lang string, n int, digest string")
    labels = spark.createDataFrame(LABELS, "doc_id int, quality int, toxic int")
    counts = failure_counts(docs.repartition(5), labels)
    assert sorted(map(tuple, audit(counts).collect())) == sorted(by_hand(DOCS, LABELS))
    assert audit(failure_counts(docs.limit(0), labels)).collect() == []
    unlabelled = audit(failure_counts(docs, labels.limit(0)))
    assert sorted(map(tuple, unlabelled.collect())) == sorted(by_hand(DOCS, []))


def test_potentials_are_those_of_the_game(spark):
    counts = spark.createDataFrame(
        [("p", mask, mask * 7 % 5, 0, 0) for mask in range(8)], "part string, mask int, n long, good long, toxic long")
    row = coalition_values(counts, 3).withColumn("potential", potentials(F.col("n"), 3)).head()
    potential = {0: Fraction(0)}
    for s in range(1, 8):
        inside = [i for i in range(3) if s >> i & 1]
        potential[s] = Fraction(row.n[s] + sum(potential[s ^ 1 << i] for i in inside), len(inside))
    assert row.potential == [6 * potential[s] for s in range(8)]


def divergences(rows, min_docs, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = Counter(term.findall((text or "").translate(lower)))
        counts[lang, source].update(found)
        docs[lang].update(found.keys())
    out = []

    def shares(own, kept):
        total = sum(own[t] for t in kept)
        return {t: 1 + 10**9 * (own[t] + 2) // (total + 2 * len(kept)) for t in kept}

    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: own for (g, s), own in counts.items() if g == lang}
        p = {s: shares(own, kept) for s, own in groups.items()}
        q = shares(sum(groups.values(), Counter()), kept)

        def apart(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            pair = [(-sum(apart(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            telling = [(-apart(p[s][t], q[t]), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(telling, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -value, k) for k, (value, item) in enumerate(items, 1)]
    return sorted(out)


def corpus():
    rows = []
    for k in range(60):
        words = [f"w{chr(97 + j)}" for j in range(26) if (j * k) % 7 < 3] * (1 + k % 3)
        rows.append((" ".join(words) + " É1é_É", ["en", "de", None][k % 3], f"s{k % 5}"))
    rows += [("Shared text here", "en", f"s{k % 4}") for k in range(40)] * 2
    rows += [("shared Text here", "de", None), (None, "fr", "s1"), (None, "fr", "s2"), ("", "", ""), ("lone", "xx", "s9")]
    rows += [("term " * 100_000, "en", "s1")]
    return rows


@pytest.mark.parametrize("limit", [1 << 20, 0])
@pytest.mark.parametrize("min_docs", [1, 4, 10, 10_000])
def test_source_divergence(spark, limit, min_docs):
    rows = corpus()
    table = spark.createDataFrame([(*r, 5, 6) for r in rows], "text string, lang string, source string, n int, term int")
    found = source_divergence(table.repartition(4), min_docs=min_docs, top_terms=3, max_broadcast=limit)
    assert sorted(map(tuple, found.collect())) == divergences(rows, min_docs, 3)


def test_source_divergence_of_an_empty_table(spark):
    table = spark.createDataFrame([], "text string, lang string, source string")
    assert source_divergence(table).collect() == []


def test_gathered_terms_are_handed_on(spark, monkeypatch):
    """The bound on what a task gathers changes nothing."""
    import lexispan.llm.source_audit as module

    rows = corpus()
    table = spark.createDataFrame(rows, "text string, lang string, source string")
    texts = module.collapsed_texts(table)
    want = {(r.lang, r.term): (sorted(map(tuple, r.own)), r.n) for r in module.kept_terms(module.weighted_terms(texts), 2).collect()}
    monkeypatch.setattr(module, "GATHERED", 3)
    got = {(r.lang, r.term): (sorted(map(tuple, r.own)), r.n) for r in module.kept_terms(module.weighted_terms(texts), 2).collect()}
    assert got == want and want
