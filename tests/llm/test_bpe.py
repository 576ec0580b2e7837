"""Tree concatenation against the tokenizer library on whole texts."""

import random
import unicodedata

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexispan.llm.bpe import Codec, Encoding, codec_of, decode_ids, encode_texts, halves, join_halves, join_tree

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as file:
    CODEC = codec_of(file.read())

PIECES = st.sampled_from([
    "the", "don't", "'re", "''s", "straße", "ΣΑΣ", "İ", "日本語", "漢", "🎉", "👩‍🚀", "é", "́", "̧́",
    "한", "<|startoftext|>", "<|endof", "text|>", "<|", " ", "\t\n", " ", " ", "\x1c", "\x85", "12",
    "3.5", "!!!", "....", "aaaaaaaa", "abababab", "ſ", "ﬁ", "क्षि", "ไม้", "x", "th", "in", "\x00", "\x7f", "_",
])
TEXTS = st.lists(PIECES | st.text(max_size=4), max_size=120).map("".join)


def whole(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def by_tree(text, leaf_chars, first_window=40):
    leaves = {low: CODEC.leaf(text[low:high], low) for low, high in halves(0, len(text), leaf_chars)}
    return join_tree(CODEC, text, 0, len(text), leaves, leaf_chars, first_window).ids.tolist()


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(20, 200))
def test_tree_is_the_whole_encoding(text, leaf_chars):
    assert by_tree(text, leaf_chars) == whole(text)
    assert CODEC.ids(text.encode("utf-8", "ignore")).tolist() == whole(text)


@pytest.mark.parametrize("alphabet", ["a", "ab", "aeinrst", "日本語中文字", "🎉é", "!?.", "1a", "́a"])
def test_long_unsplit_texts(alphabet):
    random.seed(alphabet)
    for n in (500, 3000):
        text = "".join(random.choice(alphabet) for _ in range(n))
        for leaf_chars in (100, 257, 1000):
            assert by_tree(text, leaf_chars) == whole(text)


def test_a_window_is_small_and_the_rest_comes_from_the_halves():
    """Ids outside the window are those of the halves, even where these were tampered with."""
    text = "some words of a plain sentence " * 40
    cut = len(text) // 2 + 3
    left, right = CODEC.leaf(text[:cut], 0), CODEC.leaf(text[cut:], cut)
    left.ids = left.ids.copy()
    left.ids[0] = 7
    joined = join_halves(CODEC, text, 0, cut, len(text), left, right).ids.tolist()
    assert joined == [7, *whole(text)[1:]]


def test_a_window_grows_until_both_sides_agree():
    text = "word " * 50
    cut = 125
    wrong = Encoding(CODEC.leaf(text[:cut], 0).ids + 1, CODEC.leaf(text[:cut], 0).starts)
    joined = join_halves(CODEC, text, 0, cut, len(text), wrong, CODEC.leaf(text[cut:], cut))
    assert joined.ids.tolist() == whole(text)


ROWS = [
    (1, "The  quick brown fox, isn't it?"), (1, "The  quick brown fox, isn't it?"), (2, None), (3, ""), (4, " \n\t"),
    (None, "no id"), (5, "x<|endoftext|>y"), (6, "lorem ipsum dolor " * 400), (6, "lorem ipsum dolor " * 400),
    (7, "abcdefgh" * 700), (8, "漢字かな交じり文。" * 300), (None, "z1!" * 900), (9, " " * 5000), (10, "café " * 300),
]


def test_table(spark):
    table = spark.createDataFrame(
        [(i, t, 1, [2], "x") for i, t in ROWS], "doc_id int, text string, ids int, _row array<int>, low string")
    encoded = encode_texts(table, PATH, leaf_chars=500)
    assert encoded.columns == ["doc_id", "ids"]
    rows = decode_ids(encoded, PATH).collect()
    key = repr
    assert sorted(((r.doc_id, r.ids) for r in rows), key=key) == sorted(((i, whole(t or "")) for i, t in ROWS), key=key)
    for r in rows:
        assert r.decoded == LIBRARY.decode(r.ids, skip_special_tokens=False)
    assert encode_texts(table.limit(0), PATH).collect() == []
    both = encode_texts(table, PATH, leaf_chars=500, decoded="id").collect()
    assert sorted(map(repr, both)) == sorted(repr(r).replace("decoded=", "id=") for r in rows)


def test_decoding_of_null_and_unknown_ids(spark):
    table = spark.createDataFrame([(None, "a"), ([], "b"), ([320, -1, 99_999_999, 1125], "c")], "ids array<int>, decoded string")
    assert [r.decoded for r in decode_ids(table, PATH).collect()] == ["", "", "a</w> photo</w>"]


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file, pytest.raises(ValueError):  # splits that keep blanks
        Codec(file.read()).library


def test_query_against_the_library(spark):
    import hashlib

    from lexispan.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = {}
    for i, text in texts.items():
        ids = whole(text)
        want[i] = (len(ids), digest(" ".join(map(str, ids))), digest(LIBRARY.decode(ids, skip_special_tokens=False)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op11_bpe"](spark, sf_dir).collect()}
    assert got == want


def test_marks_apart_from_their_base():
    text = "a" * 90 + "e" + "̧́" * 40 + "b" * 90
    assert unicodedata.normalize("NFC", text) != text
    assert by_tree(text, 60) == whole(text)
