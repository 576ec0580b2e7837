"""Exact, near and substring deduplication on small hand-made tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lexispan.llm import columns
from lexispan.llm.components import components
from lexispan.llm.exact_dedup import drop_copies, exact_groups
from lexispan.llm.simhash import BKTree, drop_near_duplicates, fingerprint, fingerprint_links, near_duplicates
from lexispan.llm.substring_dedup import lengths, remove_repeats

SCHEMA = "doc_id long, text string, dropped int, _doc string, digest string, keep_id int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "y", 2) for i, t in rows], SCHEMA)


ROWS = [(1, "A b"), (2, "a B"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "x" * 200_000),
        (8, "x" * 200_000), (9, "a b "), (9, "a b "), (None, "a b")]


@pytest.mark.parametrize("options", [
    {}, {"files_per_batch": 1}, {"digest_of": lambda t: F.substring(F.sha2(t, 256), 1, 0).cast("binary")},
])
def test_exact_groups(spark, options):
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in
             exact_groups(table(spark, ROWS).repartition(3), **options).collect()}
    assert found == {
        (1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (3, 3, 1, True), (4, 4, 1, True),
        (5, 6, 2, False), (6, 6, 2, True), (7, 8, 2, False), (8, 8, 2, True), (9, 9, 2, True),
    }


def test_exact_groups_with_many_hits(spark, monkeypatch):
    """The join by shuffle gives the rows of the broadcast one."""
    from lexispan.llm import exact_dedup

    want = sorted(map(repr, exact_groups(table(spark, ROWS)).collect()))
    monkeypatch.setattr(exact_dedup, "MAX_BROADCAST_HITS", 0)
    assert sorted(map(repr, exact_groups(table(spark, ROWS)).collect())) == want


def test_exact_of_empty_table_and_filter(spark):
    assert exact_groups(table(spark, [])).collect() == []
    kept = drop_copies(table(spark, ROWS))
    assert kept.columns == table(spark, []).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [2, 3, 4, 6, 8, 9]


def brute_removal(rows, window):
    first = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for k in range(len(words) - window + 1):
            key = tuple(words[k:k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w.decode() for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [1, 2, 3, 8, 13, 20, 50])
def test_substring_dedup(spark, window):
    rng = random.Random(window)
    passages = [[rng.choice("ab cd ef gh".split()) + str(rng.randrange(40)) for _ in range(rng.randrange(5, 90))]
                for _ in range(12)]
    rows = []
    for i in range(60):
        words = [w for _ in range(rng.randrange(4)) for w in (
            rng.choice(passages) if rng.random() < 0.5 else [rng.choice("abc") for _ in range(rng.randrange(40))])]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    rows += [(60, None), (61, ""), (62, " \x0b "), (None, rows[3][1]), (70, "same " * 400), (71, "same " * 30),
             (72, "é ü " * 20), (73, "é ü " * 20), (74, rows[5][1]), (74, "other " + rows[7][1])]
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in
                  remove_repeats(table(spark, rows).repartition(4), window=window).collect()), key=repr)
    assert got == brute_removal(rows, window)


def test_substring_dedup_of_empty_table(spark):
    assert remove_repeats(table(spark, [])).collect() == []


def test_lengths_double():
    for window in range(1, 200):
        found = lengths(window)
        assert found[-1] == window and all(a < b <= 2 * a for a, b in zip(found, found[1:], strict=False))


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(1)
    tree, values = BKTree(), []
    for _ in range(400):
        value = rng.getrandbits(64) if rng.random() < 0.3 or not values else rng.choice(values) ^ (1 << rng.randrange(64))
        if value not in values:
            values.append(value)
            tree.add(value)
    for query in values[:50]:
        for radius in (0, 3, 10):
            got = sorted(tree.values[n] for _, n in tree.within(query, radius))
            assert got == sorted(v for v in values if (v ^ query).bit_count() <= radius)


def brute_components(values, radius):
    least = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= radius and least[b] < least[a]:
                    least[a], changed = least[b], True
    groups = {}
    for v, root in least.items():
        groups.setdefault(root, set()).add(v)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("tree_size", [4, 2000])
def test_links_of_shards_that_are_cut_again(spark, tree_size):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {rng.getrandbits(64) for _ in range(60)}
    for _ in range(150):
        v = base
        for bit in rng.sample(range(64), rng.randrange(8)):
            v ^= 1 << bit
        values.add(v)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = fingerprint_links(spark.createDataFrame(signed, "fp long"), 3, tree_size)
    found = {r.node: r.component for r in components(links).collect()}
    groups = {}
    for v, in signed:
        groups.setdefault(found.get(v, v), set()).add(v % (1 << 64))
    assert sorted(map(sorted, groups.values())) == brute_components(sorted(values), 3)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_near_duplicates_edge_rows(spark):
    rows = [(3, None), (2, ""), (None, " "), (7, "one two three four"), (8, "ONE two three four"), (9, "other words")]
    got = {(r.doc_id, r.component) for r in near_duplicates(table(spark, rows)).collect()}
    assert got == {(3, 2), (2, 2), (None, 2), (7, 7), (8, 7), (9, 9)}
    assert near_duplicates(table(spark, [])).collect() == []


def edited(rng, words, edits):
    words = list(words)
    for k in rng.sample(range(len(words)), edits):
        words[k] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def brute_near_rows(rows):
    """Which (id, text) stay: the smallest of each component of the texts' fingerprints."""
    keys = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()))
    prints = [fingerprint((t or "").encode(), 3) for _, t in keys]
    root = list(range(len(keys)))
    changed = True
    while changed:
        changed = False
        for a in range(len(keys)):
            for b in range(a):
                if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return [key for k, key in enumerate(keys) if root[k] == k]


def repeated_rows(rng):
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(20):
        base = rng.choices(vocabulary, k=rng.randrange(200, 500))
        rows += [(rng.randrange(60), edited(rng, base, rng.choice([0, 1, 2, 30]))) for _ in range(rng.choice([1, 2, 6]))]
    rows += [(i, t) for i, t in rows[:9]] + [(7, t) for _, t in rows[9:14]] + [(None, rows[0][1]), (None, rows[0][1])]
    return rows + [(5, "dup"), (9, "dup"), (5, "only here"), (7, "x y"), (7, "x y"), (None, ""), (3, None), (2, " "), (None, "lone")]


def test_near_duplicates_are_dropped_by_row(spark):
    rows = repeated_rows(random.Random(8))
    kept = drop_near_duplicates(table(spark, rows).repartition(3))
    assert kept.columns == table(spark, []).columns
    found = [(r.doc_id, hashlib.sha256((r.text or "").encode()).digest()) for r in kept.collect()]
    assert sorted(found, key=repr) == sorted(
        ((i, hashlib.sha256((t or "").encode()).digest()) for i, t in brute_near_rows(
            [(i, t or "") for i, t in rows])), key=repr)
    assert drop_near_duplicates(table(spark, [])).collect() == []


@pytest.mark.parametrize("most", [500_000, 0])
def test_copies_are_dropped_by_row(spark, monkeypatch, most):
    monkeypatch.setattr(columns, "MAX_BROADCAST_KEYS", most)
    rows = repeated_rows(random.Random(9)) + [(4, "Dup"), (9, "DUP"), (None, "Nameless"), (None, "nameless")]
    best = {}
    for i, t in rows:
        text = "".join(c.lower() if c.isascii() else c for c in t or "")
        best[text] = max(best.get(text, -1), -1 if i is None else i)
    kept = drop_copies(table(spark, rows).repartition(3))
    assert kept.columns == table(spark, []).columns
    found = [("".join(c.lower() if c.isascii() else c for c in r.text or ""), -1 if r.doc_id is None else r.doc_id)
             for r in kept.collect()]
    assert sorted(found) == sorted(best.items())
