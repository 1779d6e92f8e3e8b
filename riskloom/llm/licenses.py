"""License scans with a positional index of rare words.

The index maps the words of license templates to their positions. How rare a
word is, is counted over all documents. In a file, the rarest words of each key
phrase are looked up; their places, moved back by their positions in the
template, must meet in the same start; what meets is then verified word by
word. A template is found when all its key phrases are, and its score is the
share of its words, weighted by rarity, that stand where the template has them.

Every place of a phrase holds its rarest words, so no place is missed.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]
    base: bool = False


# Wording of well-known licenses and notices, and the phrases that must be there.
TEMPLATES = (
    *(Template(label, phrase, (phrase,), True) for phrase, label in BASE_PHRASES.items()),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
        ("apache license version 2 0", "except in compliance with the license"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee "
        "is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify and or distribute this software for any purpose",),
    ),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("mpl-2", "licensed under the mozilla public license version 2 0", ("mozilla public license version 2",)),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software released into the public domain",),
    ),
    Template("cc0", "released under cc0 1 0 universal", ("cc0 1 0",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
)

# ASCII bytes that are no letter or digit become blanks; bytes of other characters belong to words.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words; none for a null text."""
    return (text or b"").lower().translate(_LETTERS).split()


class Index:
    """Postings of the templates' words, with the lookup words of every key phrase."""

    def __init__(self, templates: tuple[Template, ...], rarity: dict[bytes, float]):
        self.templates = [(t, t.text.encode().split()) for t in templates]
        self.rarity = rarity
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, text) in enumerate(self.templates):
            for at, w in enumerate(text):
                self.postings[w].append((n, at))
        # Per template and key phrase: the phrase, its place in the template, and its two rarest words there.
        self.phrases = []
        self.needed: set[bytes] = set()
        for n, (t, text) in enumerate(self.templates):
            for phrase in t.keys:
                key = phrase.encode().split()
                place = next(i for i in range(len(text)) if text[i : i + len(key)] == key)
                spots = sorted(range(len(key)), key=lambda i: (-rarity.get(key[i], 0.0), key[i], i))[:2]
                rare = [(key[i], place + i) for i in spots]
                self.phrases.append((n, key, place, rare))
                self.needed.update(w for w, _ in rare)

    def places(self, text: list[bytes]) -> list[tuple[str, int, int, bool, float]]:
        """(label, first word, end, base, score) of every place, by first word."""
        seen = set(text) & self.needed
        open_phrases = [p for p in self.phrases if all(w in seen for w, _ in p[3])]
        if not open_phrases:
            return []
        at: dict[bytes, list[int]] = defaultdict(list)
        for i, w in enumerate(text):
            if w in seen:
                at[w].append(i)
        starts: dict[int, list[list[int]]] = defaultdict(list)
        for n, key, place, rare in open_phrases:
            meet = set.intersection(*({i - r for i in at[w]} for w, r in rare))
            starts[n].append(
                sorted(s for s in meet if s + place >= 0 and text[s + place : s + place + len(key)] == key)
            )
        out = []
        for n, found in starts.items():
            template, body = self.templates[n]
            if len(found) < len(template.keys) or not all(found):
                continue
            total = sum(self.rarity.get(w, 0.0) for w in body) or 1.0
            place = next(p for m, _, p, _ in self.phrases if m == n)
            size = len(template.keys[0].split())
            for s in found[0]:
                same = sum(
                    self.rarity.get(w, 0.0) for i, w in enumerate(body) if 0 <= s + i < len(text) and text[s + i] == w
                )
                out.append((template.label, s + place, s + place + size, template.base, same / total))
        return sorted(out, key=lambda x: (x[1], x[0], not x[3]))


def rarity(docs: DataFrame, text_col: str, templates: tuple[Template, ...] = TEMPLATES) -> dict[bytes, float]:
    """log(1 + N / (1 + documents with the word)) of each template word, over all documents."""
    vocabulary = frozenset(w for t in templates for w in t.text.encode().split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            n += batch.num_rows
            for t in batch.column(0).cast(pa.binary()):
                counts.update(vocabulary.intersection(words(t.as_py())))
        keys = [*counts, b""]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k.decode() for k in keys]), pa.array([*counts.values(), n], pa.int64())], ["word", "n"]
        )

    counted = docs.select(text_col).mapInArrow(run, "word string, n bigint")
    found = {r["word"].encode(): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    total = found.get(b"", 0)
    return {w: math.log(1 + total / (1 + found.get(w, 0))) + 1e-9 for w in vocabulary}


PLACE = "struct<label:string,first:bigint,end:bigint,base:boolean,score:double>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per document: ``doc_id, n_words, places``.

    ``places`` lists each place of a template (label, first word and end of its
    first key phrase, whether it is a base phrase, score), by first word. A null
    text has no words and no places. Ids may be null or repeat; rows stay. Other
    columns are not read.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    index = Index(templates, rarity(plain, "text", templates))
    fields = [
        ("label", pa.string()),
        ("first", pa.int64()),
        ("end", pa.int64()),
        ("base", pa.bool_()),
        ("score", pa.float64()),
    ]
    kind = pa.list_(pa.struct(fields))
    names = [n for n, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places = [], []
            for t in batch.column(1).cast(pa.binary()):
                text = words(t.as_py())
                sizes.append(len(text))
                places.append([dict(zip(names, p)) for p in index.places(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(places, kind)], ["doc_id", "n_words", "places"]
            )

    key = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {key}, n_words bigint, places array<{PLACE}>")


def labels_of(places: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
