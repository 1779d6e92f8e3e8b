"""Language-model scores by a hierarchical Pitman-Yor model.

Restaurants, from the leaves up:

- one per preceding token: every distinct word of the training texts, and the start;
- one per kind of token that stands before (CONTEXTS kinds), the parent of those of its words;
- one for words, the shared parent of the kinds;
- spelling: one per context of up to five letters, whose parent is that of the
  context without its first letter, down to one for all letters and the uniform
  distribution. It gives every string a probability, so new words have one too.

Customers of a restaurant are the tokens seen there, and each of its tables is a
customer of its parent. Seatings are sampled by Gibbs sweeps: every dish of a
restaurant is seated anew by the Chinese-restaurant rule, given its parent's
probabilities and the restaurants' table totals of the sweep before. Predictive
probabilities are averages over the sweeps kept: of the tables and of the parent's
probabilities in a preceding word's restaurant, of the probabilities above it.

The words with their counts and the pairs of neighbours with theirs are distributed
tables. A dish seen once has one table, so only pairs seen twice or more are seated.
A sweep seats these pairs, adds what their tables have gained to the words (as dishes
of the kinds, and as restaurants), and then seats the kinds and the words. Both are
written once per sweep, in place of those of the sweep before, and only the totals
reach the driver: a row per sweep. What is broadcast is bounded: the spelling tables (the commonest
contexts), the FREQUENT commonest words and the PAIRS commonest pairs. Other tokens
are joined with the probabilities of their pairs. These leave out a pair of two common
words that is seen once, in training texts alone: a training text's token without a
row there is of such a pair.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from riskloom.llm.samples import held_out
from riskloom.session import drop_finished, remove, scratch_path, stage, staging

CONTEXTS = 6
SYMBOLS = 257
END = 256
STRENGTH = 1.0
# Letters of the longest spelling context; contexts of up to SHORT letters are all
# kept, of each longer length about LETTER_CONTEXTS.
ORDER = 5
SHORT = 2
LETTER_CONTEXTS = 1 << 13
# Words whose probabilities are sent to every task.
FREQUENT = 1 << 17
# Pairs of neighbours whose probabilities are sent to every task.
PAIRS = 1 << 19
CACHED_WORDS = 300_000
TOKENS_AT_ONCE = 1 << 20
COUNTS = [f"c{i}" for i in range(CONTEXTS)]
PROBS = [f"p{i}" for i in range(CONTEXTS)]
# Of a word: its tables in the kinds, and its probabilities summed over the sweeps kept.
TABLES = [f"t{i}" for i in range(CONTEXTS)]
SUMS = [f"q{i}" for i in range(CONTEXTS)]
# A word as a context: its hash, whose lowest bits are its kind.
KIND_BITS = 7
# Counts in training texts and in held-out ones, as one number.
HELD = 32


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words and the end, which is the empty string."""
    return [*(text or b"").lower().split(), b""]


def context(word: bytes) -> int:
    """The kind of context that a word makes for the next; 0 stands for the start of a text."""
    last = word[-1]
    if last in b".!?:;":
        return 1
    if 0x30 <= last <= 0x39:
        return 2
    if last < 0x80 and not 0x61 <= last <= 0x7A:
        return 3
    return 4 if len(word) <= 3 else 5


def word_hashes(found: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, 42) for w in found), np.uint64, len(found)).view(np.int64)


def as_contexts(hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    return (hashes & ~KIND_BITS) | kinds


def pair_keys(w: np.ndarray, u: np.ndarray) -> np.ndarray:
    """One hash of a word and the context before it; :func:`pair_key` is the same of columns."""
    u = u.view(np.uint64)
    return (u << np.uint64(21) ^ u >> np.uint64(43)).view(np.int64) ^ w


def pair_key(w: Column, u: Column) -> Column:
    return F.shiftleft(u, 21).bitwiseXOR(F.shiftrightunsigned(u, 43)).bitwiseXOR(w)


def discount(ones: float, twos: float) -> float:
    """From the dishes seen once and twice."""
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones > 0 else 0.5


def seat(n: np.ndarray, prior: np.ndarray, d, mass, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``n`` customers, seated one after the other.

    ``prior`` is the parent's probability of the dish, ``mass`` the restaurant's
    weight of a new table (strength + discount * tables). Later customers of
    large dishes are seated in blocks of a quarter of those already there.
    """
    tables = np.ones(len(n), dtype=np.int64)
    fresh = mass * prior
    d = np.broadcast_to(d, n.shape)
    seated = 1
    todo = np.flatnonzero(n > seated)
    while len(todo):
        block = np.minimum(max(1, seated // 4), n[todo] - seated)
        p = fresh[todo] / (seated - d[todo] * tables[todo] + fresh[todo])
        tables[todo] += rng.binomial(block, np.clip(p, 0, 1))
        seated += max(1, seated // 4)
        todo = todo[n[todo] > seated]
    return np.minimum(tables, n)


def grams(found: list[bytes]) -> np.ndarray:
    """Codes of ORDER letters and the next, of the letters of each word and its end, in a row.

    A code's digits are letters, the farthest first, so the code of a shorter
    context is a remainder. END stands before a word and after it.
    """
    flat = np.frombuffer(b"\n".join(found) + b"\n", dtype=np.uint8).astype(np.int64)
    flat[flat == 10] = END
    code, before, scale = flat.copy(), flat, SYMBOLS
    start = np.ones(len(flat), bool)
    start[1:] = flat[:-1] == END
    open_ = ~start
    for _ in range(ORDER):
        before = np.concatenate([[END], before[:-1]])
        code += np.where(open_, before, END) * scale
        scale *= SYMBOLS
        # Beyond the start of the word there is only END.
        open_ = open_ & np.concatenate([[False], open_[:-1]])
    return code


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``wanted`` in sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Level:
    """One seating of the restaurants of one context length: probabilities of seen codes, back-off weights."""

    codes: np.ndarray
    prob: np.ndarray
    contexts: np.ndarray
    back: np.ndarray


@dataclass
class Spelling:
    """Averages over several seatings of the letter restaurants."""

    seatings: list[list[Level]]  # by context length, from 0 on

    def letters(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of codes, one row per seating."""
        out = np.empty((len(self.seatings), len(codes)))
        for row, levels in zip(out, self.seatings):
            row[:] = 1 / SYMBOLS
            for order, level in enumerate(levels):
                code = codes % SYMBOLS ** (order + 1)
                where, open_ = _place(level.contexts, code // SYMBOLS)
                at, seen = _place(level.codes, code)
                if len(level.contexts):
                    row[open_] *= level.back[where[open_]]
                if len(level.codes):
                    row[seen] = level.prob[at[seen]]
        return out

    def log10(self, found: list[bytes]) -> np.ndarray:
        """log10 probability of each word, its end included."""
        if not found:
            return np.zeros(0)
        codes, inverse = np.unique(grams(found), return_inverse=True)
        lengths = np.fromiter((len(w) + 1 for w in found), np.int64, len(found))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        total = np.full(len(found), -np.inf)
        for p in self.letters(codes):
            total = np.logaddexp(total, np.add.reduceat(np.log(p)[inverse], starts))
        return (total - np.log(len(self.seatings))) / np.log(10)


def fit_spelling(direct: dict[int, tuple[np.ndarray, np.ndarray]], sweeps: int = 4, kept: int = 2, seed: int = 3) -> Spelling:
    """Sample seatings of the letter restaurants.

    ``direct`` has, per context length, the sorted codes and counts of the
    customers that sit there themselves; tables of longer contexts join them.
    """
    rng = np.random.default_rng(seed)
    top = max(direct, default=0)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    # All codes of a level, its own customers, and where its tables sit one level below.
    codes: list[np.ndarray] = [np.zeros(0, np.int64)] * (top + 1)
    own: list[np.ndarray] = [np.zeros(0, np.int64)] * (top + 1)
    below: list[np.ndarray] = [np.zeros(0, np.int64)] * (top + 1)
    above = np.zeros(0, np.int64)
    for order in range(top, -1, -1):
        mine, n = direct.get(order, none)
        codes[order] = np.unique(np.concatenate([mine, above]))
        own[order] = np.zeros(len(codes[order]), np.int64)
        own[order][np.searchsorted(codes[order], mine)] = n
        above = codes[order] % SYMBOLS**order if order else above
    for order in range(1, top + 1):
        below[order] = np.searchsorted(codes[order - 1], codes[order] % SYMBOLS**order)
    contexts = [np.unique(c // SYMBOLS) for c in codes]
    inside = [np.searchsorted(x, c // SYMBOLS) for x, c in zip(contexts, codes)]
    tables = [np.ones(len(c), np.int64) for c in codes]
    out = []
    for sweep in range(sweeps):
        customers, discounts = [], []
        extra = np.zeros(0, np.int64)
        for order in range(top, -1, -1):
            n = own[order] + (extra if len(extra) else 0)
            customers.append(n)
            discounts.append(discount((n == 1).sum(), (n == 2).sum()))
            if order:
                extra = np.bincount(below[order], tables[order], len(codes[order - 1])).astype(np.int64)
        customers.reverse()
        discounts.reverse()
        levels, parent = [], np.full(len(codes[0]), 1 / SYMBOLS)
        for order in range(top + 1):
            n, d, at = customers[order], discounts[order], inside[order]
            if order:
                parent = levels[-1].prob[below[order]]
            mass = STRENGTH + d * np.bincount(at, tables[order], len(contexts[order]))
            # Tables one level up were seated before; a table is never without a customer.
            tables[order] = seat(n, parent, d, mass[at], rng)
            total = STRENGTH + np.bincount(at, n, len(contexts[order]))
            back = (STRENGTH + d * np.bincount(at, tables[order], len(contexts[order]))) / total
            prob = (n - d * tables[order]) / total[at] + back[at] * parent
            levels.append(Level(codes[order], prob, contexts[order], back))
        if sweep >= sweeps - kept:
            out.append(levels)
    return Spelling(out)


def count_letters(words_: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts of letters in distinct words, by the longest context kept for them.

    Contexts of up to SHORT letters are all kept; of longer ones, those of the
    LETTER_CONTEXTS commonest, and those they go on from. Others sit with their parent.
    """

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            if names:
                codes, n = np.unique(grams(names), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], ["code", "n"])

    counted = words_.select("word").mapInArrow(letters, "code bigint, n bigint")
    counted = stage(counted.groupBy("code").agg(F.sum("n").alias("n")), "letter-counts")
    kept: dict[int, np.ndarray] = {}
    for order in range(ORDER, SHORT, -1):
        ctx = F.floor(F.col("code") % SYMBOLS ** (order + 1) / SYMBOLS).cast("bigint")
        common = most_frequent(counted.groupBy(ctx.alias("h")).agg(F.sum("n").alias("c")), LETTER_CONTEXTS)
        own = common.toPandas()["h"].to_numpy(np.int64)
        longer = kept[order + 1] % SYMBOLS**order if order + 1 in kept else np.zeros(0, np.int64)
        kept[order] = np.unique(np.concatenate([own, longer]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy(zero_copy_only=False)
            order = np.full(len(code), SHORT)
            for o in range(SHORT + 1, ORDER + 1):
                order[np.isin(code % SYMBOLS ** (o + 1) // SYMBOLS, kept[o])] = o
            cut = code % np.array([SYMBOLS ** (o + 1) for o in range(ORDER + 1)])[order]
            yield pa.RecordBatch.from_arrays([pa.array(order), pa.array(cut), batch.column(1)], ["o", "code", "n"])

    placed = counted.select("code", "n").mapInArrow(place, "o bigint, code bigint, n bigint")
    rows = placed.groupBy("o", "code").agg(F.sum("n").alias("n")).toPandas().sort_values("code")
    return {int(o): (g["code"].to_numpy(np.int64), g["n"].to_numpy(np.int64)) for o, g in rows.groupby("o")}


@dataclass
class Totals:
    """Customers and tables of the word restaurants, and their discounts."""

    customers: np.ndarray
    leaf_discount: np.ndarray
    root_discount: float
    tables: list[np.ndarray]  # per sweep and context; the state before the first sweep comes first
    root_tables: list[float]

    def root(self, sweep: int, m: np.ndarray, s: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        mass = STRENGTH + self.root_discount * self.root_tables[sweep]
        return (m - self.root_discount * s + mass * spelled) / (STRENGTH + self.tables[sweep].sum())

    def leaf_mass(self, sweep: int) -> np.ndarray:
        return STRENGTH + self.leaf_discount * self.tables[sweep]


def swept(counts: np.ndarray, spelled: np.ndarray, totals: Totals, sweep: int, t: np.ndarray, s: np.ndarray, rng: np.random.Generator):
    """The tables per word and context, and the root tables per word, seated anew given those after ``sweep``."""
    before = totals.root(sweep, t.sum(axis=1), s, spelled)
    mass = totals.leaf_mass(sweep)
    t = t.copy()
    for j in range(CONTEXTS):
        has = np.flatnonzero(counts[:, j])
        t[has, j] = seat(counts[has, j], before[has], totals.leaf_discount[j], mass[j], rng)
    root_mass = STRENGTH + totals.root_discount * totals.root_tables[sweep]
    return t, seat(t.sum(axis=1), spelled, totals.root_discount, root_mass, rng)


def sweeps_of(counts: np.ndarray, spelled: np.ndarray, totals: Totals, sweeps: int, seed: list[int]):
    """Seatings after sweeps 0, 1, ..., ``sweeps`` of words whose customers stay."""
    t, s = (counts > 0).astype(np.int64), np.ones(len(counts), np.int64)
    yield t, s
    for sweep in range(1, sweeps + 1):
        t, s = swept(counts, spelled, totals, sweep - 1, t, s, np.random.default_rng([*seed, sweep]))
        yield t, s


def predictive(counts: np.ndarray, spelled: np.ndarray, totals: Totals, sweep: int, t: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Probability of each word in each context, for one seating."""
    root = totals.root(sweep, t.sum(axis=1), s, spelled)
    own = counts - totals.leaf_discount * t
    return (own + totals.leaf_mass(sweep) * root[:, None]) / (STRENGTH + totals.customers)


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (binary) of all texts of ``docs(held_out, text)``, with its count ``c`` in those not held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            names, numbers = list(counts), list(counts.values())
            for at in range(0, len(names), 20_000):
                part = [pa.array(names[at : at + 20_000], pa.binary()), pa.array(numbers[at : at + 20_000], pa.int64())]
                yield pa.RecordBatch.from_arrays(part, ["word", "c"])

        for batch in batches:
            for held, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                own = 0 if held else 1
                for w in words(t.as_py()):
                    counts[w] = counts.get(w, 0) + own
                if len(counts) > CACHED_WORDS:
                    yield from rows()
                    counts = {}
        yield from rows()

    return docs.select("held_out", "text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def count_pairs(docs: DataFrame) -> DataFrame:
    """``w, u, n``: a word's hash, the context before it, and how often: held-out texts count from bit HELD on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[bytes, int] = {b"": 0}
        flat: list[int] = []
        sizes: list[int] = []
        outs: list[bool] = []

        def rows() -> Iterator[pa.RecordBatch]:
            names = list(ids)
            hashes = word_hashes(names)
            contexts = as_contexts(hashes, np.array([context(w) if w else 0 for w in names]))
            word = np.array(flat, dtype=np.int64)
            # The end makes the context of a start, so texts can follow each other.
            before = np.concatenate([[0], word[:-1]])
            out = np.repeat(np.array(outs, dtype=np.int64), np.array(sizes))
            code, n = np.unique((before * len(names) + word) * 2 + out, return_counts=True)
            n = n.astype(np.int64) << (code % 2 * HELD)
            before, word = np.divmod(code // 2, len(names))
            for at in range(0, len(n), 100_000):
                own = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[word[own]]), pa.array(contexts[before[own]]), pa.array(n[own])], ["w", "u", "n"])

        for batch in batches:
            for held, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found = words(t.as_py())
                flat += [ids.setdefault(w, len(ids)) for w in found]
                sizes.append(len(found))
                outs.append(held)
                if len(flat) >= TOKENS_AT_ONCE:
                    yield from rows()
                    ids, flat, sizes, outs = {b"": 0}, [], [], []
        if flat:
            yield from rows()

    counted = docs.select("held_out", "text").mapInArrow(run, "w bigint, u bigint, n bigint").repartition("w")
    return counted.groupBy("w", "u").agg(F.sum("n").alias("n")).sortWithinPartitions("w")


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)


def _word_table(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts, spelling probabilities, tables in the kinds and at the root of a batch of words."""
    spelled, s = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("spelled", "s"))
    return _columns(batch, COUNTS).astype(np.int64), 10**spelled, _columns(batch, TABLES).astype(np.int64), s.astype(np.int64)


def _mark(hashes: pa.Array) -> int:
    """A number that seeds the draws of a batch."""
    return zlib.crc32(hashes.to_numpy(zero_copy_only=False)[:1].tobytes())


@dataclass
class Model:
    spelling: Spelling
    totals: list[Totals]  # of the sweeps kept
    tokens: int
    distinct: int
    pair_discount: float
    table: DataFrame  # h, u, c, v, p0...: hash, hash as context, count, mean tables as context, log10 probabilities by kind
    seats: DataFrame  # w, u, n, t: the pairs seen twice or more in training texts, with their mean tables
    rest: DataFrame  # w, u, n: the other pairs

    def unseen(self) -> np.ndarray:
        """log10 of what a new word gets in each kind of context before its spelling."""
        total = np.zeros(CONTEXTS)
        for totals in self.totals:
            mass = STRENGTH + totals.root_discount * totals.root_tables[0]
            root = mass / (STRENGTH + totals.tables[0].sum())
            total += totals.leaf_mass(0) * root / (STRENGTH + totals.customers)
        return np.log10(total / len(self.totals))


def totals_of(table: DataFrame) -> Totals:
    """The customers and tables of the kinds and of the root in ``table``, and the discounts that follow from them."""
    sums = [F.sum(c) for c in [*COUNTS, *TABLES, "s"]]
    per = [F.count(F.when(F.col(c) == v, 1)) for v in (1, 2) for c in COUNTS]
    above = sum(F.col(t) for t in TABLES)
    root = [F.count(F.when(above == v, 1)) for v in (1, 2)]
    got = [x or 0 for x in table.agg(*sums, *per, *root).first()]
    customers, tables, ones, twos = (np.array(x, dtype=np.float64) for x in (got[:CONTEXTS], got[CONTEXTS : 2 * CONTEXTS], got[-2 * CONTEXTS - 2 : -CONTEXTS - 2], got[-CONTEXTS - 2 : -2]))
    leaf = np.array([discount(a, b) for a, b in zip(ones, twos)])
    return Totals(customers, leaf, discount(*got[-2:]), [tables], [float(got[2 * CONTEXTS])])


def in_training(n: str = "n") -> Column:
    return F.col(n).bitwiseAND(F.lit((1 << HELD) - 1))


def by_kind(value: Column) -> list[Column]:
    """Sums of ``value`` over pairs, by the kind of their contexts."""
    kind = F.col("u").bitwiseAND(F.lit(KIND_BITS))
    return [F.sum(F.when(kind == j, value).otherwise(0)).alias(c) for j, c in enumerate(COUNTS)]


def learn(docs: DataFrame, sweeps: int = 3, kept: int = 2, seed: int = 23) -> Model:
    """Count the words and pairs of ``docs(held_out, text)``, sample seatings of the training ones, and
    write the tables that predictive probabilities are made of."""
    spark = docs.sparkSession
    pairs = stage(count_pairs(docs), "pair-counts")
    drop_finished(spark)
    paths = [scratch_path(spark, label) for label in ("seated-pairs", "word-probabilities")]
    with staging(spark):  # only these stay
        model = _learn(docs, pairs, paths, sweeps, kept, seed)
    drop_finished(spark)
    return model


def _learn(docs: DataFrame, pairs: DataFrame, paths: list[str], sweeps: int, kept: int, seed: int) -> Model:
    names = stage(count_words(docs), "word-counts")
    c = in_training()
    got = pairs.agg(*[F.count(F.when(c == v, 1)) for v in (1, 2)]).first()
    leaf = discount(*got)
    spelling = fit_spelling(count_letters(names.where("c > 0")), seed=seed)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            hashes = word_hashes(found)
            contexts = as_contexts(hashes, np.array([context(w) if w else 0 for w in found], dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), pa.array(contexts), batch.column(1), pa.array(spelling.log10(found))], ["h", "u", "c", "spelled"]
            )

    spelled = stage(names.mapInArrow(spell, "h bigint, u bigint, c bigint, spelled double"), "spelled-words")

    def seen(tables: DataFrame, value: Column, before: DataFrame, *others: str) -> DataFrame:
        """The words of ``before`` with the sums of ``value`` added: as dish by kind, as context in all."""
        dishes = tables.groupBy("w").agg(*[x.alias(f"+{c}") for c, x in zip(COUNTS, by_kind(value))])
        rooms = tables.groupBy("u").agg(F.sum(value).alias("+v"))
        both = before.join(dishes, F.col("h") == F.col("w"), "left").drop("w").join(rooms, "u", "left")
        more = {x: F.coalesce(F.col(x), F.lit(0)) + F.coalesce(F.col(f"+{x}"), F.lit(0)) for x in [*COUNTS, "v"]}
        return both.select("h", *[more[x].alias(x) for x in COUNTS], "spelled", "u", "c", more["v"].alias("v"), *others)

    empty = {x: F.lit(0).cast("bigint") for x in [*COUNTS, "v"]}
    begun = seen(pairs.where(c > 0), F.lit(1), spelled.where("c > 0").withColumns(empty))
    begun = begun.withColumns({t: (F.col(x) > 0).cast("bigint") for t, x in zip(TABLES, COUNTS)} | {"s": F.lit(1).cast("bigint")})
    path = scratch_path(docs.sparkSession, "word-tables")
    begun = begun.withColumns({q: F.lit(0).cast("float") for q in SUMS} | {"vs": F.lit(0).cast("bigint")})
    carried = state = stage(begun, "word-tables", path)
    totals = totals_of(state)
    words_ = ", ".join(f"{x} {'float' if x in SUMS else 'double' if x == 'spelled' else 'bigint'}" for x in state.columns)
    # Pairs with their tables, those of the sweep before, and those of the sweeps kept summed up.
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    seats = pairs.where(c > 1).select("w", "u", "n", one.alias("t"), one.alias("old"), none.alias("ts"))
    many, after = "w bigint, u bigint, n bigint, t bigint, old bigint, ts bigint", []

    def priors(totals: Totals):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts, base, t, s = _word_table(batch)
                p = predictive(counts, base, totals, 0, t, s).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column("h"), *(pa.array(p[:, j].copy()) for j in range(CONTEXTS))], ["w", *PROBS])

        return run

    def seated(sweep: int, keep: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, old, ts, v, prior = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("n", "t", "ts", "v", "prior"))
                rng = np.random.default_rng([seed, sweep, _mark(batch.column("w"))])
                t = seat(n & ((1 << HELD) - 1), prior, leaf, STRENGTH + leaf * v, rng)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(t), pa.array(old), pa.array(ts + t if keep else ts)], ["w", "u", "n", "t", "old", "ts"])

        return run

    def reseated(totals: Totals, sweep: int):
        """The words whose customers are those of this sweep, and whose tables those of the one before, with theirs of this one."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts, base, t, s = _word_table(batch)
                rng = np.random.default_rng([seed, sweep, _mark(batch.column("h")), 1])
                t, s = swept(counts, base, totals, 0, t, s, rng)
                new = {x: pa.array(t[:, j].copy()) for j, x in enumerate(TABLES)} | {"s": pa.array(s)}
                yield pa.RecordBatch.from_arrays([new.get(x, batch.column(x)) for x in batch.schema.names], batch.schema.names)

        return run

    def summed(totals: Totals, table: DataFrame) -> DataFrame:
        """The words with their probabilities and tables after a sweep that is kept added to the sums."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts, base, t, s = _word_table(batch)
                q = _columns(batch, SUMS) + predictive(counts, base, totals, 0, t, s)
                new = {x: pa.array(q[:, j].astype(np.float32)) for j, x in enumerate(SUMS)}
                vs = batch.column("vs").to_numpy(zero_copy_only=False) + batch.column("v").to_numpy(zero_copy_only=False)
                new["vs"] = pa.array(vs)
                yield pa.RecordBatch.from_arrays([new.get(x, batch.column(x)) for x in batch.schema.names], batch.schema.names)

        return table.mapInArrow(run, words_)

    spark, held = docs.sparkSession, [path]
    for sweep in range(1, sweeps + 1):
        keep, last = sweep > sweeps - kept, sweep == sweeps
        given = state.mapInArrow(priors(totals), "w bigint, " + ", ".join(f"{p} float" for p in PROBS))
        placed = seats.join(given, "w").join(state.select("u", "v"), "u").select("w", "u", "n", "t", "ts", "v", of_kind().alias("prior"))
        # The last ones stay.
        own = paths[0] if last else scratch_path(spark, "seated-pairs")
        seats = stage(placed.mapInArrow(seated(sweep, keep), many), "seated-pairs", own)
        moved = seen(seats.where("t <> old"), F.col("t") - F.col("old"), carried, *TABLES, "s", *SUMS, "vs")
        path = scratch_path(spark, "word-tables")
        carried = state = stage(moved.select(*state.columns).mapInArrow(reseated(totals, sweep), words_), "word-tables", path)
        totals = totals_of(state)
        if keep:
            after.append(totals)
            carried = summed(totals, state)
        remove(spark, held)
        held = [path] if last else [path, own]
        drop_finished(spark)

    def probabilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = np.log10(_columns(batch, SUMS).astype(np.float64) / len(after)).astype(np.float32)
            v = batch.column("vs").to_numpy(zero_copy_only=False) / len(after)
            own = [batch.column("h"), batch.column("u"), batch.column("c"), pa.array(v)]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(logs[:, j].copy()) for j in range(CONTEXTS))], ["h", "u", "c", "v", *PROBS])

    schema = "h bigint, u bigint, c bigint, v double, " + ", ".join(f"{p} float" for p in PROBS)
    size = names.where("c > 0").agg(F.sum("c"), F.count(F.lit(1))).first()
    mean = seats.select("w", "u", "n", (F.col("ts") / len(after)).alias("t"))
    model = Model(spelling, after, size[0] or 0, size[1], leaf, carried, mean, pairs.where(c < 2))
    # A word of held-out texts alone has what a new word gets.
    new = spelled.where("c = 0").select("h", "u", "c", F.lit(0.0).alias("v"), *[(F.lit(float(x)) + F.col("spelled")).cast("float").alias(p) for p, x in zip(PROBS, model.unseen())])
    model.table = stage(carried.mapInArrow(probabilities, schema).unionByName(new), "word-probabilities", paths[1])
    return model


def of_kind() -> Column:
    """The column of PROBS for the kind of the context ``u``."""
    kind = F.col("u").bitwiseAND(F.lit(KIND_BITS))
    return F.coalesce(*[F.when(kind == j, F.col(p).cast("double")) for j, p in enumerate(PROBS)])


def pair_scores(model: Model, common: Column) -> DataFrame:
    """``key, c, lp, own``: log10 probabilities of the pairs that occur in held-out texts, are seen twice or more in
    training texts, or have a word that is not ``common``; and the own count of a word that is not."""
    words_ = model.table.select("h", "u", "c", "v", *PROBS, F.coalesce(common, F.lit(False)).alias("common"))
    near = words_.where("common")
    rest = model.rest.join(F.broadcast(near.select(F.col("h").alias("w"), F.lit(1).alias("a"))), "w", "left")
    rest = rest.join(F.broadcast(near.select("u", F.lit(1).alias("b"))), "u", "left")
    rest = rest.where((F.shiftright("n", HELD) > 0) | F.col("a").isNull() | F.col("b").isNull())
    all_ = model.seats.unionByName(rest.select("w", "u", "n", in_training().cast("double").alias("t")))
    d = F.lit(model.pair_discount)
    # A word's own count is wanted where it is not common alone.
    dish = words_.select(F.col("h").alias("w"), F.when(~F.col("common"), F.col("c")).alias("own"), *PROBS)
    room = words_.select("u", (F.col("c") + STRENGTH).alias("size"), (STRENGTH + d * F.col("v")).alias("mass"))
    placed = all_.join(dish, "w").select(
        "u", pair_key(F.col("w"), F.col("u")).alias("key"), in_training().alias("c"), "t", "own", of_kind().cast("float").alias("prior")
    )
    p = (F.col("c") - d * F.col("t") + F.col("mass") * F.pow(F.lit(10.0), F.col("prior").cast("double"))) / F.col("size")
    return placed.join(room, "u").select("key", "c", F.log10(p).cast("float").alias("lp"), "own")


def commonest(table: DataFrame, most: int) -> Column:
    """Whether a row of ``table`` is among those with the highest counts ``c``, at most ``most``, cut where the
    logarithm of the count has a step.

    A sort with a limit would send that many rows of every task to the driver;
    the steps of the logarithm are some thousands, whatever the table.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 64)
    sizes = {r["step"]: r["n"] for r in table.where("c > 0").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()}
    lowest, total = None, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        lowest = at
    return F.lit(False) if lowest is None else (F.col("c") > 0) & (step >= lowest)


def most_frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows with the highest counts, at most ``most``."""
    return table.where(commonest(table, most))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    A null text counts as empty and has the end token only. A null id is not
    held out. Repeated rows count and are scored each for itself. Without
    training text the spelling alone decides. Words are matched by a 64-bit hash.
    """
    plain = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col), 10, 0).alias("held_out"), F.col(text_col).alias("text")
    )
    spark = plain.sparkSession
    path = scratch_path(spark, "pair-scores")
    with staging(spark):  # what learning wrote goes when the pairs have their scores
        model = learn(plain, **options)
        near = commonest(model.table, FREQUENT)
        common = model.table.where(near).toPandas().sort_values("h")
        pairs = stage(pair_scores(model, near), "pair-scores", path)
    drop_finished(spark)
    hashes = common["h"].to_numpy(np.int64)
    counts = common["c"].to_numpy(np.float64)
    log_c = np.log10(counts + 0.1)
    probs = 10 ** common[PROBS].to_numpy(np.float64)
    # Of a common word as context: the weight of its kind's probabilities, and what a word seen there once has itself.
    back = (STRENGTH + model.pair_discount * common["v"].to_numpy(np.float64)) / (STRENGTH + counts)
    once = (1 - model.pair_discount) / (STRENGTH + counts)
    frequent = most_frequent(pairs, PAIRS).select("key", "lp").toArrow().sort_by("key")
    pair_hashes, pair_logs = (frequent.column(x).to_numpy() for x in ("key", "lp"))
    norm = float(np.log10(model.tokens + 0.1 * (model.distinct + 1)))
    key = plain.schema["doc_id"].dataType.simpleString()
    document = pa.struct(
        [
            ("doc_id", to_arrow_type(plain.schema["doc_id"].dataType)),
            ("held_out", pa.bool_()),
            ("n", pa.int64()),
            ("known", pa.int64()),
            ("base", pa.float64()),
            ("score", pa.float64()),
        ]
    )
    columns = ["row", "key", "once", "far", "doc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        ids: dict[bytes, int] = {}
        of: list[tuple[int, int, int]] = []  # hash, place among the common words or -1, kind of context

        def flush(rows: list[tuple], flat: list[int]) -> Iterator[pa.RecordBatch]:
            word = np.array(flat, dtype=np.int64)
            info = np.array(of, dtype=np.int64).reshape(-1, 3)
            sizes = np.array([r[3] for r in rows], dtype=np.int64)
            owner = np.repeat(np.arange(len(rows)), sizes)
            # Every text has an end, which makes the context of a start.
            before = np.concatenate([[ids[b""]], word[:-1]])
            place, room, kind = info[word, 1], info[before, 1], info[before, 2]
            near = place >= 0
            known = np.bincount(owner[near], minlength=len(rows))
            base = np.bincount(owner[near], log_c[place[near]] - norm, len(rows))
            key = pair_keys(info[word, 0], as_contexts(info[before, 0], kind))
            at, here = _place(pair_hashes, key)
            sent = near & here
            total = np.bincount(owner[sent], pair_logs[at[sent]], len(rows))
            far = np.flatnonzero(~sent)
            # What a pair of common words that is seen once has.
            alone = np.full(len(far), np.nan, np.float32)
            inside = np.flatnonzero(near[far] & (room[far] >= 0))
            w, u = place[far[inside]], room[far[inside]]
            alone[inside] = np.log10(once[u] + back[u] * probs[w, kind[far[inside]]])
            row_id = np.array([r[0] for r in rows], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row_id),
                    # A hash of the row spreads these rows; what they match counts for nothing.
                    pa.array(row_id * np.int64(-7046029254386353131)),
                    pa.array(np.zeros(len(rows), np.float32)),
                    pa.array(np.zeros(len(rows), bool)),
                    pa.array(
                        [
                            {"doc_id": r[1], "held_out": r[2], "n": int(n), "known": int(k), "base": float(b), "score": float(s)}
                            for r, n, k, b, s in zip(rows, sizes, known, base, total)
                        ],
                        document,
                    ),
                ],
                columns,
            )
            for first in range(0, len(far), 100_000):
                part = far[first : first + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row_id[owner[part]]),
                        pa.array(key[part]),
                        pa.array(alone[first : first + 100_000]),
                        pa.array(~near[part]),
                        pa.nulls(len(part), document),
                    ],
                    columns,
                )

        rows: list[tuple] = []
        flat: list[int] = []
        for batch in batches:
            for row, doc, out, t in zip(*(batch.column(i) for i in range(3)), batch.column(3).cast(pa.binary())):
                found = words(t.as_py())
                for w in found:
                    i = ids.get(w)
                    if i is None:
                        i = ids[w] = len(ids)
                        h = digest(w, 42)
                        h -= (h >> 63) << 64
                        p = int(np.searchsorted(hashes, h))
                        of.append((h, p if p < len(hashes) and hashes[p] == h else -1, context(w) if w else 0))
                    flat.append(i)
                rows.append((row.as_py(), doc.as_py(), out.as_py(), len(found)))
                if len(flat) >= TOKENS_AT_ONCE:
                    yield from flush(rows, flat)
                    rows, flat = [], []
                    if len(ids) > CACHED_WORDS:
                        ids, of = {}, []
        if rows:
            yield from flush(rows, flat)

    fields = f"doc_id {key}, held_out boolean, n bigint, known bigint, base double, score double"
    tokens = plain.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        run, f"row bigint, key bigint, once float, far boolean, doc struct<{fields}>"
    )
    joined = tokens.join(pairs.drop("c"), "key", "left")
    token = F.col("doc").isNull()
    summed = joined.groupBy("row").agg(
        F.max("doc").alias("doc"),
        F.count(F.when(token & F.col("far") & (F.col("own") > 0), 1)).alias("known"),
        F.sum(F.when(token & F.col("far"), F.log10(F.col("own") + 0.1) - norm)).alias("base"),
        F.sum(F.when(token, F.coalesce("lp", "once").cast("double"))).alias("score"),
    )
    none = F.lit(0.0)
    return summed.select(
        "doc.doc_id",
        "doc.held_out",
        F.col("doc.n").alias("n_tokens"),
        (F.col("doc.known") + F.col("known")).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("doc.base") + F.coalesce("base", none)).alias("base_score"),
        (F.col("doc.score") + F.coalesce("score", none)).alias("score"),
    )
