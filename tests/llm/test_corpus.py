"""Toxicity, decontamination, mixing and the pipeline on small tables."""

import hashlib
import math
import random

import numpy as np
import pytest

import corpus_pipeline
from lexispan.llm.decontaminate import Items, alignment, contamination, drop_contaminated
from lexispan.llm.mixing import mix_sources
from lexispan.llm.simhash import fingerprint
from lexispan.llm.toxicity import Model, drop_toxic, fit, fold, score_texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def test_folding():
    assert fold("1D10T") == " idiot " == fold("іdіоt") == fold("i\u200bdi\u00adot")
    assert fold("$tupid") == "  tupid " and fold("st@r!s") == " staris "
    assert fold("THE!! 50%***").split() == ["the", "so"]


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ter") for b in ("na", "ru", "sel") for c in ("do", "fin", "wa")]
    rows, labels = [], []
    for i in range(600):
        text = rng.choices(words, k=rng.randrange(20, 120))
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["vilewort", "v1lewort", "gromchuk", "grоmchuk"]))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic), 7))
    return rows, labels


def test_learnt_lexicon(spark, prose):
    rows, labels = prose
    docs = documents(spark, [*rows, (None, None, None), (-1, "", None), (-2, "VILEWORT " + "x" * 200_000, "s")])
    table = spark.createDataFrame([*labels, (None, 1, 7), (4, None, 7)], "doc_id long, toxic int, text int")
    model = fit(docs, table)
    found = {r.doc_id: r for r in score_texts(docs, model).collect()}
    assert [found[i].predicted for i, _, _ in rows] == [t for _, t, _ in labels]
    assert found[None].score == found[-1].score < 0.5 and 0 <= found[-2].score <= 1
    assert not any("held" in t for t in model.lexicon)
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if not r.predicted}
    assert score_texts(documents(spark, []), model).collect() == []


def test_exception_phrases_spare_their_words():
    lexicon = {" trash ": 7.0}
    model = Model(lexicon, ("trash can",), (0.0, 1.0, 1.0, 1.0, 1.0))
    assert model.features("a trash can")[1] == 0 and model.features("a trash can trash")[1] == 1
    assert model.features("trashy")[1] == 0


def test_without_labels_all_scores_are_equal(spark):
    docs = documents(spark, [(1, "a", "s"), (2, "b", "s")])
    model = fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert len({r.score for r in score_texts(docs, model).collect()}) == 1


def plain_alignment(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, above[j] + (2 if x == y else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best / (2 * len(a))


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 20)), rng.integers(0, 5, rng.integers(0, 40))
        assert alignment(a, b) == pytest.approx(plain_alignment(a.tolist(), b.tolist()))


def test_contamination_by_whole_edited_and_no_copies(spark):
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(400)] + ["the", "of"] * 60
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(8)] + [(90, "too short"), (91, None), (None, "x")]
    rows, holding = [], {}
    for i in range(80):
        text = rng.choices(vocabulary, k=200)
        if i % 4 == 0:
            item = items[i % 8][1].split()
            if i % 3 == 0:
                item = [w if k % 6 else "changed" for k, w in enumerate(item)]
            if i % 5 == 0:
                item = [w.upper() + "," for k, w in enumerate(item) if k != 9]
            text[50:50] = item
            holding[i] = i % 8
        rows.append((i, " ".join(text), "s"))
    rows += [(200, None, None), (201, "", "s"), (None, rows[0][1], "s"), (202, "the " * 100_000 + items[2][1], "s")]
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r for r in contamination(docs, bench).collect()}
    holding |= {None: 0, 202: 2}
    assert {i for i, r in found.items() if r.contaminated} == set(holding)
    assert all(found[i].item_id == item for i, item in holding.items())
    assert found[200].score == found[201].score == 0
    kept = drop_contaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == set(found) - set(holding)
    empty = bench.filter("false")
    assert not any(r.contaminated for r in contamination(docs, empty).collect())
    assert contamination(documents(spark, []), bench).collect() == []
    assert Items.of([]).hashes.size == 0


def plain_mixture(rows, limit, seed, blocks_of):
    tokens = {}
    for _, text, source in rows:
        tokens.setdefault(source or "", 0)
        tokens[source or ""] += len((text or "").encode().split())
    total = sum(tokens.values())
    share = {s: t / total for s, t in tokens.items() if t}
    exponent = next(k for k in range(1 << 20 | 1)
                    if (min(share.values()) / max(share.values())) ** (k / 2**20 - 1) <= limit) / 2**20
    z = sum(p**exponent for p in share.values())
    weight = {s: p**exponent / z for s, p in share.items()}
    budget = max(tokens[s] / w for s, w in weight.items())
    out = {}
    blocks = max(1, math.ceil(budget / blocks_of))
    for source, size in tokens.items():
        own = [(i, len((t or "").encode().split())) for i, t, s in rows if (s or "") == source]
        target, epoch, used = weight.get(source, 0) * budget, 0, 0
        while epoch == 0 or (size and used < target * (1 - 1e-9)):
            epoch += 1
            start = used
            for i, n in sorted(own, key=lambda x: hashlib.md5(f"{seed}:{epoch}:{x[0]}".encode()).hexdigest()):
                whole = not size or epoch <= target / size + 1e-9
                if whole or start < target:
                    place = start / target if target else 0
                    out[i, epoch] = min(int(place * blocks), blocks - 1)
                start += n
            used += size
    return out, exponent


@pytest.mark.parametrize("limit", [1.0, 2.0, 3.5])
def test_mixture(spark, limit):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randrange(50), rng.choice(["a"] * 12 + ["b"] * 3 + ["c", None])) for i in range(400)]
    rows += [(900, "", "empty"), (901, None, "empty"), (902, "long " * 60_000, "a")]
    want, exponent = plain_mixture(rows, limit, 7, 5000)
    got = mix_sources(documents(spark, rows), max_repeats=limit, block_tokens=5000).collect()
    assert {(r.doc_id, r.epoch): r.block for r in got} == want and len(got) == len(want)
    assert {r.exponent for r in got} == {exponent}
    assert sum({r.source: r.weight for r in got}.values()) == pytest.approx(1)


def test_mixture_by_entropy_and_budget(spark):
    rows = [(i, "w " * 10, "a" if i % 4 else "b") for i in range(400)]
    got = mix_sources(documents(spark, rows), target_entropy=0.65, budget=2000).collect()
    weights = {r.source: r.weight for r in got}
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(0.65, abs=1e-4)
    for source, weight in weights.items():
        used = sum(r.n_tokens for r in got if r.source == source)
        assert weight * 2000 <= used < weight * 2000 + 10
    assert mix_sources(documents(spark, [])).collect() == []


def test_pipeline(spark, tmp_path, prose):
    rows, labels = prose
    rng = random.Random(9)
    rows = [(i, t + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(60)), f"s{i % 3}") for i, t, _ in rows]
    item = " ".join(f"item{k}" for k in range(30))
    clean = [i for i, toxic, _ in labels if not toxic]
    texts = {i: t for i, t, _ in rows}
    near = texts[clean[3]].split() + ["edited"]
    rows += [
        (1001, texts[clean[1]].upper(), "s0"), (1002, " ".join(near), "s1"),
        (1003, texts[clean[2]][:40] + " " + item + " tail", "s2"), (1004, None, None), (1005, "", "s1"),
        (clean[5], "another text of an id that stands there twice", "s1"), (clean[6], texts[clean[6]], "s2"),
    ]
    docs = documents(spark, rows).coalesce(2)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, k
        docs = after
    toxic = {i for i, t, _ in labels if t}
    prints = [fingerprint(texts.get(i, " ".join(near)).encode(), 3) for i in (clean[3], 1002)]
    assert (prints[0] ^ prints[1]).bit_count() <= 3
    left = sorted([i for i, _, _ in rows if i not in toxic and i not in (clean[1], 1002, 1003, 1004, clean[6])] + [clean[6]])
    assert sorted(r.doc_id for r in docs.collect()) == left
    mixed = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "epoch").collect()
    assert {r.doc_id for r in mixed} == set(left)


def test_stages_take_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
