"""Exact linear-interpolated quantiles at any size: two passes over the data.

The first pass makes a mergeable KLL sketch of every column beside its count and edges; the sketch says between which two values a
sought rank lies, up to its rank error. The second pass counts the rows below each bracket and the distinct values inside. Those are a
small share of the data and are written; what is left to do reads them only. The counts are exact, so they also show a bracket that
missed its rank: such a rank is narrowed from the edges of its column.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from hostpulse.session import materialise

BINS = 2048
#: Size parameter of the sketches (some 60 kB a column), and how many of its rank errors a bracket reaches to each side.
SKETCH_K = 4096
REACH = 2.0
#: Distinct values inside all brackets up to which they come to the driver; more are narrowed by counting passes over them.
MOST_VALUES = 100_000


@dataclass
class _Bracket:
    """Values in [low, high] of a column, with `before` smaller values, and the ranks sought in it."""

    column: str
    low: float
    high: float
    before: int
    ranks: list[int] = field(default_factory=list)


def quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], bins: int = BINS) -> dict[str, list[float | None]]:
    """Quantiles per column; NULLs are ignored, an empty column gives None. `df` should be a written table."""
    ranked, sizes = _ranked(df, {c: lambda n, qs=qs: {r for q in qs for r in _neighbours(n, q)} for c, qs in wanted.items()}, bins)
    return {c: [_interpolate(ranked, c, sizes[c], q) if sizes[c] else None for q in qs] for c, qs in wanted.items()}


def nth_values(df: DataFrame, wanted: Mapping[str, int], bins: int = BINS) -> dict[str, float | None]:
    """The value with so many values before it in the order of each column: one of the column's own values, bit for bit."""
    ranked, _ = _ranked(df, {c: lambda n, r=r: {r} if r < n else set() for c, r in wanted.items()}, bins)
    return {c: ranked.get((c, r)) for c, r in wanted.items()}


def _ranked(
    df: DataFrame, wanted: Mapping[str, Callable[[int], set[int]]], bins: int,
) -> tuple[dict[tuple[str, int], float], dict[str, int]]:
    """Values at the ranks that are asked for, given the number of values of a column; and those numbers."""
    columns = list(wanted)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    edge = values.agg(*[
        F.struct(
            F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high"), F.kll_sketch_agg_double(c, F.lit(SKETCH_K)).alias("sketch")
        ).alias(c) for c in columns
    ]).first()
    sizes = {c: edge[c]["n"] for c in columns}
    ranks = {c: sorted(wanted[c](n)) for c, n in sizes.items() if n}
    ranks = {c: found for c, found in ranks.items() if found}
    ranked: dict[tuple[str, int], float] = {}
    brackets = []
    for c, found in ranks.items():
        if edge[c]["low"] == edge[c]["high"]:
            ranked.update({(c, r): edge[c]["low"] for r in found})
        else:
            brackets.append(c)
    brackets = _bracketed(df, {c: ranks[c] for c in brackets}, edge)
    if brackets:
        inside = materialise(_inside(values, brackets), "quantile-brackets")
        _settle(inside, brackets, ranked, bins)
    missed = [
        _Bracket(c, edge[c]["low"], edge[c]["high"], 0, lost)
        for c, found in ranks.items() if (lost := [r for r in found if (c, r) not in ranked])
    ]
    if missed:
        each = F.explode(F.array(*[F.struct(F.lit(b.column).alias("name"), F.col(b.column).alias("value")) for b in missed])).alias("cell")
        _narrow_down(values.select(each).select("cell.name", "cell.value", F.lit(1).cast("long").alias("n")), missed, ranked, bins)
    return ranked, sizes


def _bracketed(df: DataFrame, ranks: Mapping[str, list[int]], edge) -> list[_Bracket]:
    """Per column the stretches of values in which the sketch places the ranks, without overlap."""
    if not ranks:
        return []
    error = REACH * 2.446 / SKETCH_K**0.9433  # rank error of the sketch at 99 %, by its authors' fit
    asked = {
        c: [(_share(r / edge[c]["n"] - error), _share((r + 1) / edge[c]["n"] + error)) for r in found] for c, found in ranks.items()
    }
    places = [
        F.kll_sketch_get_quantile_double(F.lit(bytes(edge[c]["sketch"])), F.array(*[F.lit(float(f)) for pair in pairs for f in pair])).alias(c)
        for c, pairs in asked.items()
    ]
    found = df.sparkSession.range(0, 1, 1, 1).select(*places).first()
    out = []
    for c, pairs in asked.items():
        stretches: list[list] = []
        for r, (low, high), a, b in zip(ranks[c], pairs, found[c][::2], found[c][1::2]):
            a, b = edge[c]["low"] if low == 0 else a, edge[c]["high"] if high == 1 else b
            if stretches and a <= stretches[-1][1]:
                stretches[-1][1] = max(b, stretches[-1][1])
                stretches[-1][2].append(r)
            else:
                stretches.append([a, b, [r]])
        out += [_Bracket(c, a, b, 0, sought) for a, b, sought in stretches]
    return out


def _share(value: float) -> float:
    return min(1.0, max(0.0, value))


def _inside(values: DataFrame, brackets: list[_Bracket]) -> DataFrame:
    """(bracket, value, n): the values inside a bracket, and the rows below it as the NULL value."""
    cells = F.array(*[
        F.when(F.col(b.column) <= b.high, F.struct(
            F.lit(i).alias("bracket"), F.when(F.col(b.column) >= b.low, F.col(b.column)).alias("value")
        ))
        for i, b in enumerate(brackets)
    ])
    each = values.select(F.explode(F.array_compact(cells)).alias("cell"))
    return each.groupBy("cell.bracket", "cell.value").agg(F.count(F.lit(1)).alias("n"))


def _settle(inside: DataFrame, brackets: list[_Bracket], ranked: dict[tuple[str, int], float], bins: int) -> None:
    """Find the ranks among the written values of the brackets."""
    found = inside.limit(MOST_VALUES + 1).collect()
    if len(found) <= MOST_VALUES:
        counted: list[list[tuple[float, int]]] = [[] for _ in brackets]
        for r in found:
            if r["value"] is None:
                brackets[r["bracket"]].before = r["n"]
            else:
                counted[r["bracket"]].append((r["value"], r["n"]))
        for b, cells in zip(brackets, counted):
            before = b.before
            for value, n in sorted(cells):
                ranked.update({(b.column, r): value for r in b.ranks if before <= r < before + n})
                before += n
        return
    for r in inside.where("value is null").collect():
        brackets[r["bracket"]].before = r["n"]
    sizes = {r["bracket"]: r["n"] for r in inside.where("value is not null").groupBy("bracket").agg(F.sum("n").alias("n")).collect()}
    for i, b in enumerate(brackets):
        b.ranks = [r for r in b.ranks if b.before <= r < b.before + sizes.get(i, 0)]
    names = F.element_at(F.array(*[F.lit(b.column) for b in brackets]), F.col("bracket") + 1)
    _narrow_down(inside.where("value is not null").select(names.alias("name"), "value", "n"), brackets, ranked, bins)


def _narrow_down(long: DataFrame, brackets: list[_Bracket], ranked: dict[tuple[str, int], float], bins: int) -> None:
    """Counting passes over (name, value, n) that narrow every rank to the value that holds it.

    Each pass counts the rows of the open brackets per bin (a map-side combined group-by that returns at most brackets x bins rows)
    and keeps only the bin of each rank. It ends when a bin holds one value.
    """
    brackets = [b for b in brackets if b.ranks]
    while brackets:
        for b in brackets:
            if b.low == b.high:
                ranked.update({(b.column, r): b.low for r in b.ranks})
        brackets = _narrow(long, [b for b in brackets if b.low < b.high], bins)


def _neighbours(n: int, q: float) -> tuple[int, int]:
    position = (n - 1) * q
    return math.floor(position), math.ceil(position)


def _interpolate(ranked: dict, column: str, n: int, q: float) -> float:
    low, high = _neighbours(n, q)
    weight = (n - 1) * q - low
    return ranked[column, low] + weight * (ranked[column, high] - ranked[column, low])


def _narrow(long: DataFrame, brackets: list[_Bracket], bins: int) -> list[_Bracket]:
    if not brackets:
        return []
    value = F.col("value")
    cell = F.coalesce(*[
        F.when(
            (F.col("name") == b.column) & value.between(b.low, b.high),
            F.struct(
                F.lit(i).alias("bracket"),
                F.least(F.lit(bins - 1), F.floor((value - b.low) / (b.high - b.low) * bins).cast("int")).alias("bin"),
            ),
        )
        for i, b in enumerate(brackets)
    ])
    counted = (
        long.select(cell.alias("cell"), "value", "n").where("cell is not null").groupBy("cell.bracket", "cell.bin")
        .agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
    )
    narrowed = []
    for i, b in enumerate(brackets):
        before = b.before
        for row in sorted((r for r in counted if r["bracket"] == i), key=lambda r: r["bin"]):
            inside = [r for r in b.ranks if before <= r < before + row["n"]]
            if inside:
                narrowed.append(_Bracket(b.column, row["low"], row["high"], before, inside))
            before += row["n"]
    return narrowed
