"""Piece encoding against the public library, over whole texts."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from riskloom.llm import pieces, queries


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def model():
    return pieces.read_model()


@pytest.fixture(scope="module")
def encoder(model):
    return pieces.Encoder(model)


PARTS = ["a", "b", "e", "er", "th", " ", "   ", "\n", "\t", "é", "😀", "▁", "ing", "The", "12", ".", "\x00", "�", "中文", "　", "<s>", "<0x0A>", "\r\n"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join) | st.text(max_size=40))
def test_cut_equals_the_library(library, encoder, model, text):
    ids = encoder.encode_text(text, {}).tolist()
    assert ids == library.encode(text)
    assert pieces.Decoder(model).decode(ids) == library.decode(ids)


def test_decoding_any_ids_equals_the_library(library, model):
    numbers, decoder = random.Random(3), pieces.Decoder(model)
    for _ in range(500):
        ids = [numbers.choice([numbers.randrange(0, 3), numbers.randrange(3, 259), numbers.randrange(32_000)]) for _ in range(numbers.randrange(12))]
        assert decoder.decode(ids) == library.decode(ids)


def test_backtracking_is_needed_and_long_texts_are_linear(library, encoder):
    numbers = random.Random(4)
    long = "".join(numbers.choice("abcdefgh") for _ in range(100_000))
    assert encoder.encode_text(long, {}).tolist() == library.encode(long)
    assert len(encoder.cut(pieces.BLANK + long)) == len(library.encode(long))
    longest_first = 0
    for _ in range(300):
        word = "".join(numbers.choice(["er", "th", "in", "ation", "s", "e"]) for _ in range(5))
        cut, at, greedy = encoder.cut(word), 0, []
        while at < len(word):
            greedy.append(next(word[at : at + n] for n in range(16, 0, -1) if n == 1 or word[at : at + n] in encoder.model.scores))
            at += len(greedy[-1])
        longest_first += cut == greedy
    assert 0 < longest_first < 300


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, text):
    ids = library.encode(text or "")
    return len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))


def test_query_equals_the_library(spark, documents, library):
    rows = queries.op11_piece_encoding(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == expected(library, texts[r.doc_id])


def test_odd_rows(spark, odd_docs, clashing, no_docs, library):
    want = sorted((r.doc_id or 0, r.text or "", *expected(library, r.text)[:1]) for r in odd_docs.collect())
    for docs in (odd_docs, clashing, odd_docs.repartition(5)):
        rows = pieces.encode_decode(docs, carry=["doc_id", "text"]).collect()
        assert sorted((r.row.doc_id or 0, r.row.text or "", len(r.ids)) for r in rows) == want
        assert all(r.decoded == library.decode(r.ids) for r in rows)
    assert pieces.encode_decode(no_docs).count() == 0
