"""Quality rules: text statistics and a decision list learned from labels.

Everything is built-in Spark expressions and aggregates. The statistics of a
text are one projection. The list is learned by sequential covering: a rule is
grown by adding the threshold condition with the best information gain on the
grow rows, then pruned to the prefix that is best on the prune rows; the rows it
covers leave, and the next rule is grown. Each step counts labels per feature
and threshold cell in one aggregate, so only those small counts reach the
driver, whatever the number of labelled rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import let, words_of
from riskloom.session import stage

# Limits of the base rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_distinct", "n_digits"]
FEATURES = [
    "n_words",
    "mean_word_chars",
    "symbol_percent",
    "dup_lines",
    "repeat_percent",
    "upper_percent",
    "distinct_percent",
    "digit_percent",
]


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in ``words``."""

    def spread(at: Column) -> Column:
        """Words under the windows that start at the sorted positions ``at``."""
        gaps = F.transform(at, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(at, k - 1))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def repeated(hashes: Column) -> Column:
        return let(F.sort_array(hashes), lambda s: F.filter(s, lambda h, k: (k > 0) & (F.get(s, k - 1) == h)))

    def few(hashes: Column, twice: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.array_contains(twice, F.get(hashes, i)))

    def many(hashes: Column) -> Column:
        """The same positions by sorting, for texts with so many repeats that a search per window is slow."""

        def again(s: Column) -> Column:
            return F.filter(
                s,
                lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
                | ((k < F.size(s) - 1) & (F.get(s, k + 1)["h"] == x["h"])),
            )

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.sort_array(F.transform(let(pairs, again), lambda x: x["i"]))

    def covered(hashes: Column) -> Column:
        def by(twice: Column) -> Column:
            return let(F.when(F.size(twice) <= 16, few(hashes, twice)).otherwise(many(hashes)), spread)

        return let(F.array_distinct(repeated(hashes)), by)

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )

    def count(hashes: Column) -> Column:
        unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(unique, F.lit(0).cast("bigint")).otherwise(covered(hashes))

    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).otherwise(
        let(words, lambda w: let(windows(w), count))
    )


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the columns of STATISTICS (bigint).

    A null text counts as an empty one: every statistic is 0. Carried columns
    must not have the names of statistics.
    """
    carried = [c for c in docs.columns if c != text_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(*carried, text.alias("__text"), words_of(F.col(text_col)).alias("__words"))
    return split.select(
        *carried,
        F.size("__words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("__text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        _dup_lines(F.col("__text")).alias("n_dup_lines"),
        _repeat_words(F.col("__words")).alias("n_repeat_words"),
        F.regexp_count("__text", F.lit("[A-Z]")).cast("bigint").alias("n_upper"),
        F.size(F.array_distinct("__words")).cast("bigint").alias("n_distinct"),
        F.regexp_count("__text", F.lit("[0-9]")).cast("bigint").alias("n_digits"),
    )


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )


def feature(name: str) -> Column:
    """A feature as a rounded double; 0 where the text has no words."""

    def per(part: str, whole: str, scale: int) -> Column:
        share = scale * F.col(part) / F.when(F.col(whole) > 0, F.col(whole))
        return F.round(F.coalesce(share, F.lit(0.0)), 3)

    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word_chars": per("word_chars", "n_words", 1),
        "symbol_percent": per("n_symbols", "n_words", 100),
        "dup_lines": F.col("n_dup_lines").cast("double"),
        "repeat_percent": per("n_repeat_words", "n_words", 100),
        "upper_percent": per("n_upper", "word_chars", 100),
        "distinct_percent": per("n_distinct", "n_words", 100),
        "digit_percent": per("n_digits", "word_chars", 100),
    }[name]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass
class Rule:
    conditions: list[Condition]
    covered: int
    precision: float

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions)) + f" ({self.precision:.2f} of {self.covered})"


@dataclass
class DecisionList:
    """Ordered rules; the first that holds rejects, no rule keeps."""

    rules: list[Rule] = field(default_factory=list)

    def keeps(self) -> Column:
        out = F.lit(True)
        for rule in reversed(self.rules):
            out = F.when(rule.column(), F.lit(False)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"reject if {r}" for r in self.rules) or "keep all"


def _gain(p: float, n: float, p0: float, n0: float) -> float:
    """Information gained on the positives that a condition keeps."""
    if p <= 0:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _cells(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """Per feature and cell between two cuts: labelled bad rows and good rows."""
    cell = [
        F.struct(
            F.lit(i).alias("f"),
            sum((F.col(f"x_{name}") > cut).cast("int") for cut in cuts[name]).alias("cell"),
        )
        for i, name in enumerate(cuts)
    ]
    counted = (
        rows.select("bad", F.explode(F.array(*cell)).alias("c"))
        .groupBy("c.f", "c.cell")
        .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
        .collect()
    )
    names = list(cuts)
    out = {name: [(0, 0)] * (len(cuts[name]) + 1) for name in names}
    for r in counted:
        out[names[r["f"]]][r["cell"]] = (r["bad"], r["good"])
    return out


def _best_condition(cells: dict[str, list[tuple[int, int]]], cuts: dict[str, list[float]], least: int):
    p0 = sum(p for p, _ in next(iter(cells.values())))
    n0 = sum(n for _, n in next(iter(cells.values())))
    best, best_gain = None, 0.0
    for name, counts in cells.items():
        low_p = low_n = 0
        for i, cut in enumerate(cuts[name]):
            low_p, low_n = low_p + counts[i][0], low_n + counts[i][1]
            for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                if p + n < least or p + n == p0 + n0:
                    continue
                gain = _gain(p, n, p0, n0)
                if gain > best_gain + 1e-9:
                    best, best_gain = Condition(name, above, cut), gain
    return best


def learn(
    labelled: DataFrame,
    max_rules: int = 8,
    max_conditions: int = 3,
    cuts_per_feature: int = 15,
    least_covered: int = 8,
    least_precision: float = 0.9,
    seed: int = 17,
) -> DecisionList:
    """A decision list from rows with STATISTICS, an id ``doc_id`` and ``bad`` (1: reject).

    Two thirds of the rows, by a hash of id and statistics, grow rules; the rest
    prune them. A rule stays when it covers ``least_covered`` prune rows with
    ``least_precision`` of them bad. No labelled row, or none that is bad, gives
    the empty list, which keeps everything.
    """
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed), *STATISTICS), F.lit(3))
    plain = labelled.select(
        F.col("bad").cast("bigint").alias("bad"),
        (part == 0).alias("prune"),
        *STATISTICS,
        *[feature(name).alias(f"x_{name}") for name in FEATURES],
    )
    rows = stage(plain, "labelled-statistics")
    steps = [(i + 1) / (cuts_per_feature + 1) for i in range(cuts_per_feature)]
    # Bad rows may be few, so their own quantiles propose cuts as well.
    bad_only = [F.percentile_approx(F.when(F.col("bad") == 1, F.col(f"x_{n}")), steps, 2000) for n in FEATURES]
    every = [F.percentile_approx(f"x_{n}", steps, 2000) for n in FEATURES]
    found = rows.agg(*every, *bad_only).first()
    cuts = {
        name: sorted({*(found[i] or []), *(found[len(FEATURES) + i] or [])}) for i, name in enumerate(FEATURES)
    }
    cuts = {name: values for name, values in cuts.items() if values}
    out = DecisionList()
    if not cuts:
        return out
    left = rows
    while len(out.rules) < max_rules:
        grow, conditions = left.where("not prune"), []
        while len(conditions) < max_conditions:
            cells = _cells(grow, cuts)
            if not sum(p for p, _ in next(iter(cells.values()))):
                break
            chosen = _best_condition(cells, cuts, least_covered)
            if chosen is None:
                break
            conditions.append(chosen)
            grow = grow.where(chosen.column())
        if not conditions:
            break
        holds, totals = F.lit(True), []
        for c in conditions:
            holds = holds & c.column()
            totals += [F.count(F.when(holds & (F.col("bad") == v), 1)) for v in (1, 0)]
        counted = left.where("prune").agg(*totals).first()
        prefixes = [(counted[2 * i], counted[2 * i + 1], i + 1) for i in range(len(conditions))]
        p, n, length = max(prefixes, key=lambda x: ((x[0] - x[1]) / max(1, x[0] + x[1]), -x[2]))
        if p + n < least_covered or p < least_precision * (p + n):
            break
        rule = Rule(conditions[:length], p + n, p / (p + n))
        out.rules.append(rule)
        left = left.where(~rule.column())
    return out


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None, **options):
    """Statistics and verdict of every document, and the learned list.

    Returns ``(frame, list)``; the frame has ``doc_id, row_key``, STATISTICS,
    ``base_failed`` and ``kept``. Labels are matched by id: rows of ``labels``
    with a null id or a null ``quality`` are left out, and an id labelled more
    than once counts as bad if any label says so. Null texts count as empty and
    fail the base rules; a null id matches no label. Repeated rows stay.
    """
    plain = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.xxhash64(F.col(id_col), F.col(text_col)) if key is None else key).alias("row_key"),
        F.col(text_col).alias("text"),
    )
    rows = stage(with_statistics(plain, "text"), "text-statistics")
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max((F.col("quality") == 0).cast("int")).alias("bad"))
    )
    rules = learn(rows.join(marks, "doc_id"), **options)
    failed = base_failed()
    return rows.withColumns({"base_failed": failed, "kept": ~failed & rules.keeps()}), rules


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that base rules and learned list keep, all columns unchanged.

    The verdict is an expression over the text, so the rows are filtered where
    they are read: computing the statistics again is cheaper than shuffling texts.
    """
    _, rules = judged(docs, labels, id_col, text_col, **options)
    rows = with_statistics(docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__text")), "__text")
    return rows.where(~base_failed() & rules.keeps()).select("__row.*")
