"""Merge-type subword pieces: exact encoding by backtracking, and decoding.

A merge tokenizer starts from the characters of a text and joins, again and
again, the neighbours whose union is the piece of highest score (the leftmost of
equals). Its result is the only way to cut the text into pieces such that every
two neighbours, joined and merged alone, fall into the same two pieces. So a cut
is found from left to right: take the longest piece that an Aho-Corasick scan
found at the position, check it against the piece before by merging the two
again, fall back to its next shorter prefix if they do not fit, and step back
when no prefix fits. Each prefix of a text has one encoding, so a position that
failed once has failed for good; a bit per position remembers that, and a text
of any length takes linear time.

Blanks become U+2581 and one more is put before the text. Two characters that
stand side by side in no piece are never joined, so a text may be cut between
them beforehand: before runs of blanks, around line ends (both are checked when
a model is read), and behind small letters. A task encodes what it remembers of
these cuttings once.

Null and empty texts have no ids and decode to an empty text. Texts of any
length, repeated rows and null keys are kept, a row each.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.sources.csv_files import quoted

BLANK = "▁"
CUTTINGS = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n+")

# Where a text changes from small letters to other characters it may be cut.
CHANGES = re.compile("[a-z](?=[^a-z])")

# Texts are worked on in blocks of about so many characters; remembered cuttings and
# pairs are forgotten beyond their bounds. Neither changes a result.
BLOCK_CHARS = 4_000_000
MOST_CUTTINGS = 600_000
MOST_PARTS = 100_000
MOST_PAIRS = 1_000_000
LONGEST_KEPT = 64


@dataclass(frozen=True)
class PieceModel:
    """A vocabulary: pieces with scores (by id; None for other ids) the ids of the 256 bytes, the unknown mark."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: tuple[int, ...]
    unknown: int
    size: int


def read_model(path: str | None = None) -> PieceModel:
    """The model file at ``path`` (default: the public 32k piece model), read on the driver.

    Models that need more than merges over unchanged text are refused.
    """
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    reader = sentencepiece.SentencePieceProcessor(model_file=path)
    size = reader.get_piece_size()
    plain = [i for i in range(size) if not (reader.is_control(i) or reader.is_unknown(i) or reader.is_byte(i))]
    names = {i: reader.id_to_piece(i) for i in plain}
    if any(reader.is_unused(i) for i in plain) or reader.normalize("A  bﬁ ") != f"{BLANK}A{BLANK}{BLANK}bﬁ{BLANK}":
        raise ValueError("only models without unused pieces, with a blank in front and unchanged text are supported")
    if any(BLANK in p.lstrip(BLANK) for p in names.values()):
        raise ValueError("a piece holds a blank after other characters")
    if any("\n" in p for p in names.values()):
        raise ValueError("a piece holds a line end")
    bytes_ = tuple(reader.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    if not all(reader.is_byte(i) for i in bytes_):
        raise ValueError("the model has no pieces for bytes")
    return PieceModel({p: reader.get_score(i) for i, p in names.items()}, {p: i for i, p in names.items()}, bytes_, reader.unk_id(), size)


class Encoder:
    """Cuts texts into pieces; made once in each task."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.widest = max(map(len, model.scores), default=0)
        if self.widest > 255:
            raise ValueError("pieces of up to 255 characters are supported")
        self.found = ahocorasick.Automaton()
        for piece in model.scores:
            self.found.add_word(piece, len(piece))
        self.found.make_automaton()
        self.together = {p[i : i + 2] for p in model.scores for i in range(len(p) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.prefixes: dict[str, str] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, by merging."""
        score, parts = self.model.scores, list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces stay as they are when joined and merged again."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.merged(left + right) == ([left, right] if left else [right])
            self.pairs[(left, right)] = known
        return known

    def shorter(self, piece: str) -> str:
        """The longest proper prefix that is a piece; a single character has none."""
        known = self.prefixes.get(piece)
        if known is None:
            scores = self.model.scores
            known = next((piece[:n] for n in range(len(piece) - 1, 1, -1) if piece[:n] in scores), piece[:1] if len(piece) > 1 else "")
            self.prefixes[piece] = known
        return known

    def cut(self, text: str) -> list[str]:
        """The pieces of a text; characters without a piece stand alone."""
        n, found = len(text), self.found
        longest = bytearray(n)
        for end, length in found.iter_long(text):
            longest[end - length + 1] = length
        if n and not longest[0]:
            longest[0] = 1
        failed = bytearray(n // 8 + 1)
        pairs, parts = self.pairs, []
        at, left, piece = 0, "", text[: longest[0]]
        while at < n:
            while piece:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    known = pairs.get((left, piece))
                    if self.fits(left, piece) if known is None else known:
                        break
                piece = self.shorter(piece)
            if piece:
                parts.append(piece)
                at, left = end, piece
                if at < n:
                    if not longest[at]:  # off the way of the scan: one of its own for the next characters
                        last, size = next(found.iter_long(text[at : at + self.widest]), (0, 0))
                        longest[at] = size if size == last + 1 else 1
                    piece = text[at : at + longest[at]]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                last = parts.pop()
                at, left = at - len(last), parts[-1] if parts else ""
                piece = self.shorter(last)
        return parts

    def encode(self, text: str) -> bytes:
        """The ids (4 bytes each) of a text in which blanks are U+2581 already."""
        ids, together, out, start = self.model.ids, self.together, [], 0
        apart = [m.end() for m in CHANGES.finditer(text) if text[m.start() : m.end() + 1] not in together]
        for stop in [*apart, len(text)]:
            part, start = text[start:stop], stop
            known = self.known.get(part)
            if known is None:
                own: list[int] = []
                for piece in self.cut(part):
                    i = ids.get(piece)
                    own += [i] if i is not None else [self.model.byte_ids[b] for b in piece.encode()]
                known = array("i", own).tobytes()
                if len(part) <= LONGEST_KEPT:
                    if len(self.known) >= MOST_PARTS:
                        self.known.clear()
                    self.known[part] = known
            out.append(known)
        return b"".join(out)

    def encode_text(self, text: str, cuttings: dict[str, bytes]) -> np.ndarray:
        """The ids of a whole text; ``cuttings`` remembers those of its parts between blanks."""
        parts = CUTTINGS.findall(BLANK + text.replace(" ", BLANK)) if text else []
        if len(cuttings) >= MOST_CUTTINGS:
            cuttings.clear()
        found = list(map(cuttings.get, parts))
        if None in found:
            for i, part in enumerate(parts):
                if found[i] is None:
                    found[i] = cuttings.get(part) or self.encode(part)
                    if len(part) <= LONGEST_KEPT:
                        cuttings[part] = found[i]
        return np.frombuffer(b"".join(found), dtype=np.int32)


class Decoder:
    """Texts from ids: control marks give none, the unknown mark gives U+2047 between blanks."""

    def __init__(self, model: PieceModel):
        self.texts: list[str | None] = [""] * model.size
        for piece, i in model.ids.items():
            self.texts[i] = piece.replace(BLANK, " ")
        self.of_byte = {i: b for b, i in enumerate(model.byte_ids)}
        for i in self.of_byte:
            self.texts[i] = None
        if model.unknown >= 0:
            self.texts[model.unknown] = " \u2047 "
        self.unknown = model.unknown

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids without the blank put in front; wrong byte runs give U+FFFD."""
        parts = list(map(self.texts.__getitem__, ids))
        first = next((k for k, part in enumerate(parts) if part != ""), None)
        if first is not None and parts[first] and ids[first] != self.unknown and parts[first].startswith(" "):
            parts[first] = parts[first][1:]
        if None in parts:
            run, out = bytearray(), []
            for i, part in zip(ids, parts):
                if part is None:
                    run.append(self.of_byte[i])
                    continue
                if run:
                    out.append(_utf8(run))
                    run = bytearray()
                out.append(part)
            parts = [*out, _utf8(run)]
        return "".join(parts)


def _utf8(run: bytearray) -> str:
    """The characters of a run of bytes; each byte of no character becomes U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            size = next((n for n in (1, 2, 3, 4) if _whole(run[at : at + n], n)), 0)
            out.append(run[at : at + size].decode() if size else "�")
            at += size or 1
        return "".join(out)


def _whole(part: bytearray, n: int) -> bool:
    try:
        return len(part) == n and len(part.decode()) == 1
    except UnicodeDecodeError:
        return False


def blocks(texts: pa.Array, most: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """A batch of texts in blocks of about ``most`` characters, each with its first row."""
    ends = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most)) + 1
        yield start, texts.slice(start, stop - start).to_pylist()
        start = stop


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that the codes name, one after the other."""
    n = sizes[codes]
    first = np.cumsum(n) - n
    return flat[np.repeat(starts[codes] - first, n) + np.arange(int(n.sum()))]


def encode_decode(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text", path: str | None = None) -> DataFrame:
    """``row`` (a struct of the carried columns), ``ids`` (array of int) and ``decoded`` of every text.

    ``ids`` are those of the merge model at ``path``, without begin and end
    marks; ``decoded`` is made from the ids. Other columns may have any name.
    """
    model = read_model(path)
    given = docs.select(
        F.struct(*[quoted(c).alias(c) for c in carry]).alias("row"),
        F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    row = given.schema["row"].dataType
    out = T.StructType([T.StructField("row", row), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(model), Decoder(model)
        cuttings: dict[str, bytes] = {}
        for batch in batches:
            for first, texts in blocks(batch.column("text")):
                ids = [encoder.encode_text(t, cuttings) for t in texts]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                decoded = [decoder.decode(x.tolist()) for x in ids]
                arrays = [pa.ListArray.from_arrays(offsets, np.concatenate(ids)), pa.array(decoded, pa.string())]
                yield pa.record_batch([batch.column("row").slice(first, len(texts)), *arrays], names=["row", "ids", "decoded"])

    return given.mapInArrow(run, out)
