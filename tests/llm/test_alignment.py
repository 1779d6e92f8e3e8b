"""Token alignment against every pair of linked tokens, written out with the public libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskloom.llm import alignment, queries


@pytest.fixture(scope="module")
def files():
    return alignment.read_tokenizers()


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = {v: k for k, v in alignment.byte_alphabet().items()}
    letters = {c: b for b, c in byte.items()}
    entries = {i: bytes(letters[c] for c in e) for e, i in a.get_vocab().items() if all(c in letters for c in e)}

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def groups(text):
        if not text:
            return [], [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        parts_a, parts_b = [entries[i] for i in ids_a], [piece(i) for i in ids_b]
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return [], [], []
        ends_a, ends_b = np.cumsum([len(p) for p in parts_a]), np.cumsum([len(p) for p in parts_b])
        found, at_a, at_b = [], 0, 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            to_a, to_b = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
            found.append((ids_a[at_a:to_a], ids_b[at_b:to_b]))
            at_a, at_b = to_a, to_b
        return ids_a, ids_b, found

    return groups


def brute(texts, library):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    all_groups = [library(t) for t in texts]
    links = [[(a, b) for ga, gb in found for a in ga for b in gb] for _, _, found in all_groups]
    held = Counter(p for own in links for p in set(own))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (ids_a, ids_b, found), own in zip(all_groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        digest = hashlib.sha256(text.encode()).hexdigest() if found else ""
        best = sum(held[p] == most[p[0]] for p in own)
        out.append((len(ids_a), len(ids_b), len(found), len(own), best, sum(held[p] for p in own), digest))
    return out


def rows_of(df):
    return sorted((r.row.doc_id if r.row.doc_id is not None else -1, *tuple(r)[1:]) for r in df.collect())


def wanted(docs, library):
    rows = docs.select("doc_id", "text").collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, *x) for r, x in zip(rows, brute([r.text for r in rows], library)))


def test_query_equals_brute_force(spark, documents, library):
    rows = sorted(tuple(r) for r in queries.op12_token_alignment(spark, "/root/testdata/sf0.001").collect())
    assert rows == wanted(documents, library)


def test_pieces_and_joined_pairs_change_nothing(spark, documents, library, files):
    docs = documents.where("length(text) < 4000")
    want = wanted(docs, library)
    for work, sent in ((7, 1 << 18), (64, 50), (32_768, 0)):
        assert rows_of(alignment.align(docs, files=files, work=work, most_sent=sent)) == want


def test_odd_rows(spark, odd_docs, clashing, no_docs, library, files):
    odd = [
        (21, "▁ marks ▁▁ and <|endoftext|> <s> </s> <0x0A>", "en", "a", 1),
        (22, "tabs\t\tand\r\n\r\n  lines\x85\xa0x \x1c\x1d y\u2003\u3000z\ufeff\u200b end\x00", "en", "a", 1),
        (23, "中文字符 и кириллица 😀😃 ééé", "zh", "a", 1),
    ]
    more = odd_docs.unionByName(spark.createDataFrame(odd, odd_docs.schema))
    want = wanted(more, library)
    assert rows_of(alignment.align(more, files=files)) == want
    assert rows_of(alignment.align(more, files=files, work=5, most_sent=3)) == want
    assert rows_of(alignment.align(clashing, files=files)) == wanted(odd_docs, library)
    assert alignment.align(no_docs, files=files).count() == 0


def test_stretches_do_not_change_the_tokens_of_either(library, files):
    both, numbers = alignment.Both(files), random.Random(8)
    signs = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u180e", "\u200b", "a", "B's", "'ll", "12", "é", "中", "!", "...", "😀", "foo"]
    texts = ["".join(numbers.choice(signs) for _ in range(numbers.randrange(1, 14))) for _ in range(1500)]
    ids, firsts = both.tokens(texts)
    for k, text in enumerate(texts):
        want = library(text)[:2]
        for side in (0, 1):
            assert ids[side][firsts[side][k] : firsts[side][k + 1]].tolist() == want[side], repr(text)


def test_pieces_have_equal_work():
    numbers = np.random.default_rng(1)
    ends_a = np.unique(numbers.integers(1, 5_000, 1_500)).astype(np.int64)
    ends_b = np.unique(np.r_[numbers.integers(1, 5_000, 700), ends_a[-1]])
    ends_b = ends_b[ends_b <= ends_a[-1]]
    firsts = [np.array([0, len(ends_a)]), np.array([0, len(ends_b)])]
    _, at_a, at_b = alignment.diagonals(ends_a, ends_b, firsts, 100)
    sizes = np.diff(np.append(at_a + at_b, len(ends_a) + len(ends_b)))
    assert len(sizes) > 15 and sizes[:-1].min() >= 99 and sizes.max() <= 101
    for i, j in zip(at_a[1:], at_b[1:]):
        assert max(ends_a[i - 1], ends_b[j - 1]) <= min(ends_a[i : i + 1].tolist() + ends_b[j : j + 1].tolist() or [10**9])
        assert not (ends_b[j : j + 1].tolist() and ends_a[i - 1] == ends_b[j])


def test_wide_groups_are_counted_by_distinct_ids():
    ids = [np.repeat([5, 6], 400), np.tile([1, 2, 3], 300)]
    owner, pair, times = alignment.linked(ids, [np.array([800]), np.array([900])], np.array([4]), 10)
    assert owner.tolist() == [4] * 6 and pair.tolist() == [51, 52, 53, 61, 62, 63]
    assert times.tolist() == [400 * 300] * 6
