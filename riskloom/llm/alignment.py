"""Alignment of the tokens of two tokenizers over the same texts.

Both tokenizers cut the bytes of a blank and the text. Where tokens of both end
at one byte, a group of tokens ends; every token of A in a group is linked to
every token of B in it. How far an id of A belongs to an id of B is the number
of documents that hold the two linked.

The merged sequence of both tokenizers' token ends is divided at equal steps.
Step d lies on the diagonal i + j = d of the grid of A's and B's tokens, and a
binary search along it finds how many ends of either come first. So each piece
has the same number of ends, whatever the texts, and is worked on without the
others: it emits the groups that lie inside it, and the tokens before its first
and after its last common end. Spark brings these boundary parts together by
document and stitches them into the groups that reach over several pieces.

A null or empty text, and one whose bytes the tokens of A or B do not give back,
has no tokens: its counts are zero and its digest is empty. Each row is a document of
its own, also if repeated or without a key. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.llm.pieces import BLANK, Encoder, PieceModel, blocks, gathered, read_model
from riskloom.session import scratch_path
from riskloom.sources.csv_files import quoted

# White space as Unicode defines it; A never joins a token over a change from other characters to these.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Nor does it over a change from letters to these signs, so a word is cut from a sign behind it.
# Pieces of B may hold a carriage return after other characters, so no cut is made before one.
STRETCHES = re.compile(
    f"[{SPACES}]*+[A-Za-z]++(?<=[a-z])(?=[.,;:!?])|[{SPACES}]*[^{SPACES}]+(?:\r[{SPACES}]*[^{SPACES}]*)*|[{SPACES}]+"
)
CUT_BEFORE = re.compile(f"[^{SPACES}{BLANK}](?!\r)[{SPACES}]|[a-z][.,;:!?]")

# Stretches whose tokens do not depend on what stands before or behind; so many are encoded together.
PLAIN = re.compile(f" [^{BLANK}]*[^{SPACES}{BLANK}]")
TOGETHER = 2_000

# Characters per block of texts; bounds the memory of a task.
BLOCK = 500_000

# Ends of tokens per piece.
WORK = 32_768

# Pairs sent to the tasks: those that most documents hold, at most so many; others are joined.
MOST_SENT = 1 << 18

# Groups with more links are counted by distinct ids.
WIDE = 4_096

# Remembered stretches; the longer ones are not kept. Neither changes a result.
MOST_STRETCHES = 400_000


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as themselves, the
    others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


@dataclass(frozen=True)
class Tokenizers:
    """What tasks need of both: the files' contents, and the piece model that was read from the second."""

    a: str
    b_file: bytes
    b: PieceModel


def read_tokenizers(path_a: str | None = None, path_b: str | None = None) -> Tokenizers:
    """Both files, read on the driver; the defaults are the public byte-level 50k and piece 32k files."""
    import public_tokenizers

    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    model = read_model(path_b)
    if any(CUT_BEFORE.search(p) for p in model.scores):
        raise ValueError("a piece of B reaches over the end of a word")
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        return Tokenizers(a.read(), b.read(), model)


class Both:
    """Tokens of both tokenizers by stretch (white space, then other characters); made once in each task."""

    def __init__(self, files: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b_file)
        self.inner = Encoder(files.b)
        byte = byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.texts_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.texts_a[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        self.texts_b = [b""] * files.b.size
        for piece, i in files.b.ids.items():
            self.texts_b[i] = piece.replace(BLANK, " ").encode()
        for value, i in enumerate(files.b.byte_ids):
            self.texts_b[i] = bytes([value])
        self.lengths = [np.array([len(t) for t in texts], dtype=np.int64) for texts in (self.texts_a, self.texts_b)]
        size_a, size_b = len(self.texts_a), len(self.texts_b)
        self.size_b = size_b
        # An id with the sign after it; the sign depends on what follows in the group.
        self.written = [f"{i},".encode() for i in range(size_a)] + [f"{i}|".encode() for i in range(size_a)]
        self.written += [f"{i},".encode() for i in range(size_b)] + [f"{i};".encode() for i in range(size_b)]
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.flat = (array("i"), array("i"))
        self.sizes = (array("i"), array("i"))
        self.fits = array("b")

    def alone(self, stretches: Sequence[str], side: int) -> list[list[int]]:
        """Ids of each stretch by itself; the library of B would put a blank in front of it."""
        if side == 0:
            return [e.ids for e in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        return [np.frombuffer(self.inner.encode(s.replace(" ", BLANK)), dtype=np.int32).tolist() for s in stretches]

    def joined(self, stretches: Sequence[str], side: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of stretches that begin with a blank and end without, encoded as one text, and their
        numbers; None if a token should reach over an end."""
        text = "".join(stretches)
        if side == 0:
            ids = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        else:
            ids = self.b.encode(text[1:])  # puts the first blank in front itself
        ids = np.array(ids, dtype=np.int32)
        ends = np.cumsum(self.lengths[side][ids])
        stops = np.cumsum([len(s.encode()) for s in stretches])
        last = np.searchsorted(ends, stops)
        if last[-1] != len(ends) - 1 or (ends[last] != stops).any():
            return None
        return ids, np.diff(last, prepend=-1)

    def learn(self, stretches: Sequence[str]) -> None:
        """Encode stretches that are not known yet, most of them as a text."""
        plain, other = [], []
        for s in stretches:
            (plain if PLAIN.fullmatch(s) else other).append(s)
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            found = [self.joined(part, side) for side in (0, 1)]
            if found[0] is None or found[1] is None:
                other += part
                continue
            raw = "".join(part).encode()
            texts = (self.texts_a, self.texts_b)
            if any(b"".join(map(texts[side].__getitem__, found[side][0].tolist())) != raw for side in (0, 1)):
                other += part
                continue
            for side in (0, 1):
                self.flat[side].frombytes(found[side][0].tobytes())
                self.sizes[side].frombytes(found[side][1].astype(np.int32).tobytes())
            self.keep(part, [True] * len(part))
        if other:
            fits = [True] * len(other)
            for side, texts in enumerate((self.texts_a, self.texts_b)):
                ids = self.alone(other, side)
                self.flat[side].extend(chain.from_iterable(ids))
                self.sizes[side].extend(map(len, ids))
                fits = [f and b"".join(map(texts.__getitem__, own)) == s.encode() for f, own, s in zip(fits, ids, other)]
            self.keep(other, fits)

    def keep(self, stretches: Sequence[str], fits: Sequence[bool]) -> None:
        self.codes.update(zip(stretches, range(len(self.fits), len(self.fits) + len(stretches))))
        self.fits.extend(fits)

    def tokens(self, texts: Sequence[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B over all texts, and the first token of each text in either, with the totals."""
        if len(self.codes) > MOST_STRETCHES:
            self.forget()
        lists = [STRETCHES.findall(" " + t) if t else [] for t in texts]
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        flat_list = list(chain.from_iterable(lists))
        found = list(map(self.codes.get, flat_list))
        if None in found:
            self.learn(list({s for s, c in zip(flat_list, found) if c is None}))
            found = [self.codes[s] if c is None else c for s, c in zip(flat_list, found)]
        codes = np.array(found, dtype=np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        wrong = np.bincount(doc, weights=np.array(self.fits)[codes] == 0, minlength=len(texts)) > 0
        keep = ~wrong[doc]
        codes, doc = codes[keep], doc[keep]
        ids, firsts = [], []
        for side in (0, 1):
            flat, sizes = np.array(self.flat[side]), np.array(self.sizes[side], dtype=np.int64)
            ids.append(gathered(flat, np.cumsum(sizes) - sizes, sizes, codes) if len(codes) else np.zeros(0, np.int32))
            per_doc = np.bincount(doc, weights=sizes[codes], minlength=len(texts)).astype(np.int64)
            firsts.append(np.concatenate([[0], np.cumsum(per_doc)]))
        return ids, firsts


def diagonals(ends_a: np.ndarray, ends_b: np.ndarray, firsts: Sequence[np.ndarray], work: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces of all texts begin: text, tokens of A before it, tokens of B before it.

    Each text is divided every ``work`` ends. A binary search along each diagonal,
    all at once, finds how many of its ends are A's (A's first among equals); a
    cut between equal ends moves behind both, so no common end is parted.
    """
    totals = np.diff(firsts[0]) + np.diff(firsts[1])
    pieces = np.maximum(1, -(-totals // work))
    doc = np.repeat(np.arange(len(totals)), pieces)
    step = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * work
    a0, b0 = firsts[0][doc], firsts[1][doc]
    n_a, n_b = firsts[0][doc + 1] - a0, firsts[1][doc + 1] - b0
    low, high = np.maximum(0, step - n_b), np.minimum(step, n_a)
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        k = np.flatnonzero(open_)
        first = ends_a[a0[k] + mid[k]] <= ends_b[b0[k] + step[k] - 1 - mid[k]]
        low[k] = np.where(first, mid[k] + 1, low[k])
        high[k] = np.where(first, high[k], mid[k])
    i, j = a0 + low, b0 + step - low
    k = np.flatnonzero((low > 0) & (step - low < n_b))
    equal = ends_a[i[k] - 1] == ends_b[j[k]]
    j[k[equal]] += 1
    return doc, i, j


def written(ids: Sequence[np.ndarray], ends: Sequence[np.ndarray], both: Both) -> tuple[np.ndarray, np.ndarray]:
    """Groups as text codes: which entry of ``both.written`` comes where, and where each group begins.

    ``ends`` are the groups' last tokens (exclusive) in A and in B.
    """
    end_a, end_b = ends
    n_a, n_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    group_a, group_b = np.repeat(np.arange(len(end_a)), n_a), np.repeat(np.arange(len(end_b)), n_b)
    out = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
    last = np.zeros(len(ids[0]), dtype=bool)
    last[end_a - 1] = True
    size_a = len(both.texts_a)
    out[np.arange(len(ids[0])) + (end_b - n_b)[group_a]] = ids[0] + np.where(last, size_a, 0)
    last = np.zeros(len(ids[1]), dtype=bool)
    last[end_b - 1] = True
    out[np.arange(len(ids[1])) + end_a[group_b]] = ids[1] + 2 * size_a + np.where(last, both.size_b, 0)
    return out, end_a - n_a + end_b - n_b


def linked(ids: Sequence[np.ndarray], ends: Sequence[np.ndarray], of: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct linked pairs per owner of groups: owner, pair (a * size_b + b), how many links.

    Wide groups are counted by their distinct ids, so their links are not written out.
    """
    end_a, end_b = ends
    n_a, n_b = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
    links = n_a * n_b
    narrow = np.flatnonzero(links <= WIDE)
    group = np.repeat(narrow, links[narrow])
    at = np.arange(len(group)) - np.repeat(np.cumsum(links[narrow]) - links[narrow], links[narrow])
    a = ids[0][(end_a - n_a)[group] + at // n_b[group]].astype(np.int64)
    b = ids[1][(end_b - n_b)[group] + at % n_b[group]]
    found = summed(of[group], a * size_b + b, None)
    wide = np.flatnonzero(links > WIDE)
    if not len(wide):
        return found
    owner, pair, times = [[x] for x in found]
    for g in wide:
        u, k = np.unique(ids[0][end_a[g] - n_a[g] : end_a[g]], return_counts=True)
        v, m = np.unique(ids[1][end_b[g] - n_b[g] : end_b[g]], return_counts=True)
        owner.append(np.full(len(u) * len(v), of[g]))
        pair.append((u.astype(np.int64)[:, None] * size_b + v).ravel())
        times.append(np.outer(k, m).ravel())
    return summed(np.concatenate(owner), np.concatenate(pair), np.concatenate(times))


def summed(owner: np.ndarray, pair: np.ndarray, times: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per owner and pair, ordered by them, with the sum of its ``times`` (None: ones)."""
    if not len(pair):
        return owner, pair, np.zeros(0, dtype=np.int64)
    span = int(pair.max()) + 1
    if times is None and int(owner.max()) * span < 2**62:
        key, n = np.unique(owner * span + pair, return_counts=True)
        return key // span, key % span, n
    order = np.lexsort((pair, owner))
    owner, pair = owner[order], pair[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])])
    n = np.ones(len(pair), dtype=np.int64) if times is None else times[order]
    return owner[first], pair[first], np.add.reduceat(n, first)


def lists(values: np.ndarray, owner: np.ndarray, owners: int, kind: pa.DataType) -> pa.Array:
    """Values, ordered by owner, as one list per owner."""
    offsets = np.searchsorted(owner, np.arange(owners + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


PIECE = {
    "piece": pa.int32(), "pieces": pa.int32(), "n_a": pa.int64(), "n_b": pa.int64(),
    "n_groups": pa.int64(), "n_links": pa.int64(), "digest": pa.string(), "inner": pa.binary(),
    "pair": pa.list_(pa.int64()), "times": pa.list_(pa.int64()), "closes": pa.bool_(),
    "head_a": pa.list_(pa.int32()), "head_b": pa.list_(pa.int32()), "tail_a": pa.list_(pa.int32()), "tail_b": pa.list_(pa.int32()),
}
PIECE_TYPE = (
    "piece int, pieces int, n_a long, n_b long, n_groups long, n_links long, digest string, inner binary, pair array<long>, "
    "times array<long>, closes boolean, head_a array<int>, head_b array<int>, tail_a array<int>, tail_b array<int>"
)


def overlaps(ids: Sequence[np.ndarray], ends: Sequence[np.ndarray], firsts: Sequence[np.ndarray], both: Both, work: int) -> tuple[np.ndarray, dict]:
    """The pieces of a block of texts: the text of each, and the columns of PIECE.

    A piece counts and writes the groups inside it. Of a text with one piece these
    are all, so its digest is made here; other pieces keep their boundary parts.
    """
    doc, at_a, at_b = diagonals(*ends, firsts, work)
    count = len(doc)
    stop_a, stop_b = np.append(at_a[1:], len(ids[0])), np.append(at_b[1:], len(ids[1]))
    pieces = np.bincount(doc, minlength=doc[-1] + 1)[doc]
    number = np.arange(count) - np.searchsorted(doc, doc)
    # Parts end at the common ends and at the ends of the pieces.
    match = np.searchsorted(ends[1], ends[0])
    common = np.flatnonzero(match < len(ends[1]))
    common = common[ends[1][match[common]] == ends[0][common]]
    common_a, common_b = common + 1, match[common] + 1
    step = np.concatenate([common_a + common_b, stop_a + stop_b])
    closed = np.concatenate([np.ones(len(common), dtype=bool), np.zeros(count, dtype=bool)])
    part_a, part_b = np.concatenate([common_a, stop_a]), np.concatenate([common_b, stop_b])
    order = np.lexsort((~closed, step))
    step, closed, part_a, part_b = step[order], closed[order], part_a[order], part_b[order]
    keep = np.diff(step, prepend=0) > 0
    closed, part_a, part_b = closed[keep], part_a[keep], part_b[keep]
    stops = stop_a + stop_b
    piece = np.searchsorted(stops, part_a + part_b)  # the first piece that ends here or later; empty pieces have no part
    begins = np.r_[True, piece[1:] != piece[:-1]] if len(piece) else np.zeros(0, dtype=bool)
    whole = closed & ~(begins & (number[piece] > 0))
    # Groups that lie inside their piece, laid side by side.
    n_a, n_b = np.diff(part_a, prepend=0), np.diff(part_b, prepend=0)
    inner = [ids[0][np.repeat(whole, n_a)], ids[1][np.repeat(whole, n_b)]]
    inner_ends = [np.cumsum(n_a[whole]), np.cumsum(n_b[whole])]
    of = piece[whole]
    owner, pair, times = linked(inner, inner_ends, of, both.size_b)
    codes, starts = written(inner, inner_ends, both)
    texts = list(map(both.written.__getitem__, codes.tolist()))
    first = np.append(starts, len(codes))[np.searchsorted(of, np.arange(count + 1))]
    digest, inside = [], []
    for k in range(count):
        text = b"".join(texts[first[k] : first[k + 1]])
        digest.append((hashlib.sha256(text[:-1]).hexdigest() if text else "") if pieces[k] == 1 else None)
        inside.append(None if pieces[k] == 1 else text)
    edges = [(edge, side) for edge in ("head", "tail") for side in "ab"]
    boundary: dict[str, list] = {c: [None] * count for c in ("closes", *map("_".join, edges))}
    for k in np.flatnonzero(pieces > 1):
        own = np.flatnonzero(piece == k)  # none if a last piece's only end went to the piece before
        boundary["closes"][k] = bool(closed[own].any())
        later = bool(number[k] > 0)
        for edge, side in edges:
            part, n, source = (part_a, n_a, ids[0]) if side == "a" else (part_b, n_b, ids[1])
            p = own[0 if edge == "head" else -1] if len(own) else None
            has = p is not None and (later if edge == "head" else not closed[p] and not (later and p == own[0]))
            boundary[f"{edge}_{side}"][k] = source[part[p] - n[p] : part[p]].tolist() if has else []
    links = np.bincount(of, weights=np.diff(inner_ends[0], prepend=0) * np.diff(inner_ends[1], prepend=0), minlength=count)
    columns = {
        "piece": number, "pieces": pieces, "n_a": stop_a - at_a, "n_b": stop_b - at_b,
        "n_groups": np.bincount(of, minlength=count), "n_links": links.astype(np.int64), "digest": digest, "inner": inside,
        "pair": lists(pair, owner, count, pa.int64()), "times": lists(times, owner, count, pa.int64()), **boundary,
    }
    return doc, {c: v if isinstance(v, pa.Array) else pa.array(v, PIECE[c]) for c, v in columns.items()}


def stitched(table: pa.Table, both_size_b: int) -> pa.Table:
    """The pieces of one text as one: boundary parts are joined until a common end closes them."""
    rows = sorted(table.drop_columns(["row"]).to_pylist(), key=lambda r: r["piece"])
    digest = hashlib.sha256()
    wrote = False
    groups, links = 0, 0
    open_a: list[int] = []
    open_b: list[int] = []
    pairs, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def write(text: bytes) -> None:
        nonlocal wrote
        digest.update((b";" if wrote else b"") + text)
        wrote = True

    for r in rows:
        open_a += r["head_a"]
        open_b += r["head_b"]
        if r["closes"] and (open_a or open_b):
            # The head ends at the piece's first common end.
            write(f"{','.join(map(str, open_a))}|{','.join(map(str, open_b))}".encode())
            groups, links = groups + 1, links + len(open_a) * len(open_b)
            ids = [np.array(open_a, dtype=np.int64), np.array(open_b, dtype=np.int64)]
            _, pair, n = linked(ids, [np.array([len(open_a)]), np.array([len(open_b)])], np.zeros(1, np.int64), both_size_b)
            pairs.append(pair)
            times.append(n)
            open_a, open_b = [], []
        if r["inner"]:
            write(r["inner"][:-1])
        pairs.append(np.array(r["pair"], dtype=np.int64))
        times.append(np.array(r["times"], dtype=np.int64))
        groups, links = groups + r["n_groups"], links + r["n_links"]
        open_a += r["tail_a"]
        open_b += r["tail_b"]
    pair = np.concatenate(pairs)
    _, pair, n = summed(np.zeros(len(pair), dtype=np.int64), pair, np.concatenate(times))
    whole = {
        "n_a": sum(r["n_a"] for r in rows), "n_b": sum(r["n_b"] for r in rows), "n_groups": groups, "n_links": links,
        "digest": digest.hexdigest(), "pair": pair.tolist(), "times": n.tolist(),
    }
    kinds = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "digest": pa.string(), "pair": PIECE["pair"], "times": PIECE["times"]}
    arrays = [table.column(c).slice(0, 1).combine_chunks() for c in ("key", "row")]
    return pa.table([*arrays, *[pa.array([whole[c]], k) for c, k in kinds.items()]], names=["key", "row", *kinds])


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder, tightly packed, and read back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


DOCUMENT = ["key", "row", "n_a", "n_b", "n_groups", "n_links", "digest", "pair", "times"]


def groups(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text", files: Tokenizers | None = None, work: int = WORK) -> DataFrame:
    """One row per document: key, carried columns, counts, digest of the groups, distinct pairs with their links."""
    files = files or read_tokenizers()
    given = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.struct(*[quoted(c).alias(c) for c in carry]).alias("row"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    schema = T.StructType([given.schema["key"], given.schema["row"], *T.StructType.fromDDL(PIECE_TYPE).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Both(files)
        for batch in batches:
            for start, texts in blocks(batch.column("text"), BLOCK):
                ids, firsts = both.tokens(texts)
                ends = [np.cumsum(both.lengths[side][ids[side]]) for side in (0, 1)]
                doc, columns = overlaps(ids, ends, firsts, both, work)
                own = pa.array(doc + start)
                named = {"key": batch.column("key").take(own), "row": batch.column("row").take(own), **columns}
                yield pa.record_batch(list(named.values()), names=list(named))

    found = stored(given.mapInArrow(run, schema), "pieces")
    size_b = files.b.size
    whole = T.StructType([f for f in schema.fields if f.name in DOCUMENT])
    several = found.where(F.col("pieces") > 1).groupBy("key").applyInArrow(lambda t: stitched(t, size_b), whole)
    return found.where(F.col("pieces") == 1).select(*DOCUMENT).unionByName(several)


def counted(found: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: documents per linked pair, and whether no pair of the same id of A has more."""
    each = found.select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    each = stored(each, "pairs").withColumn("a", F.expr(f"pair div {size_b}"))
    most = each.groupBy("a").agg(F.max("n").alias("most"))
    return each.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def sent_pairs(counts: DataFrame, most: int) -> pa.Table:
    """The pairs that most documents hold, at most ``most`` of them, chosen by a lower bound of ``n``."""
    level = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    least, total = math.inf, 0
    for r in sizes:
        total += r["count"]
        if total > most:
            break
        least = r["level"]
    if least == math.inf:
        return pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "best": pa.array([], pa.bool_())})
    return counts.where(level >= least).toArrow().sort_by("pair").combine_chunks()


def align(
    docs: DataFrame,
    carry: Sequence[str] = ("doc_id",),
    text: str = "text",
    files: Tokenizers | None = None,
    work: int = WORK,
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """``row, n_a, n_b, n_groups, n_links, n_best, count_sum, digest`` of every document.

    ``n_best`` counts the links whose pair is the one most documents hold of its
    id of A (ties included), ``count_sum`` adds the documents of every link's pair.
    ``work`` and ``most_sent`` change no result.
    """
    files = files or read_tokenizers()
    found = groups(docs, carry, text, files, work)
    counts = stored(counted(found, files.b.size), "counts")
    hot = sent_pairs(counts, most_sent)
    hot_pair, hot_n, hot_best = (hot.column(c).to_numpy() for c in ("pair", "n", "best"))
    keep = ["key", "row", "n_a", "n_b", "n_groups", "n_links", "digest"]
    schema = T.StructType(
        [*[found.schema[c] for c in keep], *T.StructType.fromDDL("n_best long, count_sum long, pair array<long>, times array<long>").fields]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            column = batch.column("pair")
            owner = np.repeat(np.arange(rows), np.diff(column.offsets.to_numpy()))
            pair, times = column.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            at = np.searchsorted(hot_pair, pair)
            here = at < len(hot_pair)
            here[here] = hot_pair[at[here]] == pair[here]
            n, best = hot_n[at[here]], hot_best[at[here]]
            sums = np.zeros((2, rows), dtype=np.int64)
            np.add.at(sums[0], owner[here], times[here] * best)
            np.add.at(sums[1], owner[here], times[here] * n)
            rest = ~here
            arrays = [*[batch.column(c) for c in keep], *[pa.array(s) for s in sums]]
            arrays += [lists(v[rest], owner[rest], rows, pa.int64()) for v in (pair, times)]
            yield pa.record_batch(arrays, names=[*keep, "n_best", "count_sum", "pair", "times"])

    judged = stored(found.select(*DOCUMENT).mapInArrow(judge, schema), "judged")
    rest = judged.select("key", F.explode(F.arrays_zip("pair", "times")).alias("x")).select("key", "x.pair", "x.times")
    rest = rest.join(counts, "pair").groupBy("key")
    rest = rest.agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    whole = judged.drop("pair", "times").join(rest, "key", "left")
    total = lambda c, more: (F.col(c) + F.coalesce(F.col(more), F.lit(0))).alias(c)
    return whole.select("row", "n_a", "n_b", "n_groups", "n_links", total("n_best", "more_best"), total("count_sum", "more_sum"), "digest")
