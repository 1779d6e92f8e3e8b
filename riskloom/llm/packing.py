"""Pack documents into sequences of several permitted lengths by best fit.

Lengths are counted; the best-fit-decreasing plan is made on these counts, with
equal bins handled together, so planning costs the same for any number of
documents. A plan says, for every length, which stretch of its documents (by
seeded hash) goes to which bins; documents find their bin by their exact rank
within their length. The counts and the plan have a row per length, at most the
longest permitted one, and per kind of bin.

An item goes to the open bin with the least room that holds it, of any capacity.
If none does, the capacity is opened that costs least per token it will hold:
items of this size, and of what is smaller its share beyond the room still open.
At the end every bin is downsized to the least permitted length of its contents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import words_of
from riskloom.llm.ranks import ranked
from riskloom.session import stage

CAPACITIES = (512, 1024, 2048, 4096)


def cost(capacity: int, start: float = 64.0, context: float = 8192.0) -> float:
    """What a sequence costs: a fixed part, its tokens, and attention that grows with their square."""
    return start + capacity + capacity * capacity / context


@dataclass
class Bins:
    """``count`` equal bins: their capacity and contents, sizes in the order they were put in."""

    capacity: int
    count: int
    sizes: tuple[tuple[int, int], ...]

    @property
    def used(self) -> int:
        return sum(s * m for s, m in self.sizes)


def _put(sizes: tuple[tuple[int, int], ...], size: int, times: int) -> tuple[tuple[int, int], ...]:
    if sizes and sizes[-1][0] == size:
        return (*sizes[:-1], (size, sizes[-1][1] + times))
    return (*sizes, (size, times))


def plan(counts: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> list[Bins]:
    """Best-fit decreasing on counts of sizes, none above the largest capacity."""
    capacities = tuple(sorted(capacities))
    largest = capacities[-1]
    open_by_room: list[list[Bins]] = [[] for _ in range(largest + 1)]
    rooms: set[int] = set()
    # Tokens in items of a size or less.
    smaller = [0] * (largest + 1)
    for size in range(1, largest + 1):
        smaller[size] = smaller[size - 1] + size * counts.get(size, 0)
    for size in sorted(counts, reverse=True):
        left = counts[size]
        fits = sorted(r for r in rooms if r >= size)
        at = 0
        while left and at < len(fits):
            room = fits[at]
            bins = open_by_room[room].pop()
            each = min(room // size, left)
            used = min(bins.count, left // each)
            if used < bins.count:
                open_by_room[room].append(Bins(bins.capacity, bins.count - used, bins.sizes))
            filled = Bins(bins.capacity, used, _put(bins.sizes, size, each))
            open_by_room[room - each * size].append(filled)
            rooms.add(room - each * size)
            left -= used * each
            if not open_by_room[room]:
                rooms.discard(room)
                at += 1
        while left:
            free = sum(r * b.count for r in rooms for b in open_by_room[r])

            def rate(c: int) -> tuple[float, int]:
                times = min(left, c // size)
                room = c - times * size
                spare = max(0, smaller[min(room, size - 1)] - free) // (left // times)
                held = times * size + min(room, spare)
                return cost(next(d for d in capacities if d >= held)) / held, c

            capacity = min((c for c in capacities if c >= size), key=rate)
            times = min(left, capacity // size)
            room = capacity - times * size
            open_by_room[room].append(Bins(capacity, left // times, ((size, times),)))
            rooms.add(room)
            left -= left // times * times
    out = [b for group in open_by_room for b in group if b.count]
    return [Bins(next(c for c in capacities if c >= b.used), b.count, b.sizes) for b in out]


def slots(bins: list[Bins]) -> dict[str, np.ndarray]:
    """For each size, stretches of ranks and where they go; sorted by size and first rank."""
    taken: Counter[int] = Counter()
    rows, first_bin = [], 0
    for b in sorted(bins, key=lambda b: (b.capacity, b.sizes)):
        offset = 0
        for size, times in b.sizes:
            rows.append((size, taken[size], first_bin, times, offset, b.capacity))
            taken[size] += times * b.count
            offset += size * times
        first_bin += b.count
    rows.sort()
    names = ("size", "rank", "bin", "times", "offset", "capacity")
    table = np.array(rows, dtype=np.int64).reshape(-1, len(names))
    return {n: table[:, i].copy() for i, n in enumerate(names)}


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacities: tuple[int, ...] = CAPACITIES,
    seed: int = 11,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, size, bin_id, capacity, bin_offset``.

    A document counts its words and one end mark; a null text has the mark only.
    A document longer than the largest capacity is cut: whole pieces of that
    length and a rest. No token is lost. Pieces of a bin do not overlap and
    end within its capacity. Repeated rows are packed each for itself; a null id
    stays null. The order of equal rows decides nothing but which copy sits where.
    """
    largest = max(capacities)
    tokens = F.size(words_of(F.col(text_col))).cast("bigint") + 1
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("key"),
        tokens.alias("tokens"),
    )
    cut = sized.select(
        "doc_id", "key", "tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("tokens") - 1) / largest))).alias("piece")
    )
    start = F.col("piece") * largest
    pieces = stage(
        cut.select(
            "doc_id",
            "piece",
            start.alias("start"),
            F.least(F.lit(largest), F.col("tokens") - start).alias("size"),
            F.xxhash64("key", "piece").alias("h"),
        ),
        "pieces",
    )
    counted = pieces.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()
    where = slots(plan({r["size"]: r["n"] for r in counted}, tuple(capacities)))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Sizes and ranks as one key: a size is below 2^20, a rank below 2^43.
        keys = (where["size"] << 43) + where["rank"]
        for pdf in frames:
            rank = pdf.pop("rank").to_numpy()
            size = pdf["size"].to_numpy()
            at = np.searchsorted(keys, (size << 43) + rank, side="right") - 1
            inside = rank - where["rank"][at]
            pdf["bin_id"] = where["bin"][at] + inside // where["times"][at]
            pdf["capacity"] = where["capacity"][at].astype(np.int32)
            pdf["bin_offset"] = (where["offset"][at] + inside % where["times"][at] * size).astype(np.int32)
            yield pdf

    placed = ranked(pieces, ["size"], "h").select("doc_id", "piece", "start", "size", "rank")
    return placed.mapInPandas(
        place, "doc_id bigint, piece bigint, start bigint, size bigint, bin_id bigint, capacity int, bin_offset int"
    )
