"""Exact quantiles over any number of rows, in two passes up to some 10^9 of them.

The built-in ``percentile`` keeps every distinct value of a group in one buffer.  Here a mergeable sketch
(KLL, built into Spark) guesses between which two values a wanted rank lies.  One pass then counts the values
inside those brackets one by one, and all other rows by the gap they fall into, so every rank is
settled exactly; one that the sketch had misjudged shows up in a gap and is counted again in a wider bracket.
Both passes are ordinary aggregations, combined before the shuffle.  Brackets are cut by rank, not by width, so skewed or
repeated values make no difference.

Sketches can be kept: ``sketches`` writes one per file, period or other group, and ``quantiles`` merges them in place
of its first pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor, isinf

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.functions.columns import column, known_values

GRID = 512  # probes of a sketch
ACCURACY = 2000  # a rank from a sketch is off by one in so many, or less, in 99 cases of 100
HELD = 8_000_000  # rows of a bracket up to which its values are counted one by one
_WIDER = 8  # after a rank was missed


@dataclass(frozen=True)
class _Bracket:
    """The values of a column, by its number, from ``low`` to ``high``; None is unbounded.
    """

    column: int
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(f"v{self.column}")
        if self.low is None:
            return value.isNotNull()
        return F.coalesce((value >= self.low) & (value <= self.high), F.lit(False))

    def under(self) -> Column:
        if self.low is None:
            return F.lit(False)
        return F.coalesce(F.col(f"v{self.column}") < self.low, F.lit(False))


@dataclass(frozen=True)
class _Probed:
    """A bracket with the rows under it and in it, and its values at the steps of the grid."""

    bracket: _Bracket
    under: int
    rows: int
    found: list[float]

    def closer(self, rank: int, slack: float) -> _Bracket:
        """The part that holds the rank, if the sketch is no more than ``slack`` rows wrong."""
        steps, own = len(self.found) - 1, rank - self.under
        low = floor(min(max(0.0, (own - slack) / self.rows), 1.0) * steps)
        high = ceil(max(min(1.0, (own + slack) / self.rows), 0.0) * steps)
        return _Bracket(self.bracket.column, self.found[low], self.found[high])


def sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, accuracy: int = ACCURACY
) -> DataFrame:
    """One row for each group of ``by``: count, least, most and sketch of every column, to be stored and merged later.

    The columns are n0, a0, z0, s0, n1, ... in the order of ``columns``.
    """
    values = known_values(df, columns, by)
    aggregates = []
    for i in range(len(columns)):
        v = F.col(f"v{i}")
        sketch = F.when(F.count(v) > 0, F.kll_sketch_agg_double(v, F.lit(_size(accuracy))))
        aggregates += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"z{i}"), sketch.alias(f"s{i}")]
    return values.groupBy(*[column(c) for c in by]).agg(*aggregates)


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    *,
    grid: int = GRID,
    accuracy: int = ACCURACY,
    held: int = HELD,
    stored: DataFrame | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation; missing values are left out.

    Two passes over ``df``, one with ``stored`` sketches of exactly its rows and these columns (of ``sketches``).
    A bracket of more than ``held`` rows is probed again first, which takes a pass for every factor of some
    hundreds.  The driver receives ``grid`` values per bracket and pass, and at the end the values of the ranks.
    """
    if any(not 0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    values = known_values(df, columns)
    whole = [_Bracket(i) for i in range(len(columns))]
    probed = _merged(stored, whole, grid) if stored is not None else _probe(values, whole, grid, accuracy)
    rows = [p.rows for p in probed]
    for i, p in enumerate(probed):
        if p.rows and (isinf(p.found[0]) or isinf(p.found[-1])):
            raise ValueError(f"{columns[i]} has infinite values")
    # per wanted rank: where it was sought last, and how much wider than expected
    open_ = {
        (i, rank): (probed[i], 1)
        for i in range(len(columns))
        for position in (p * (rows[i] - 1) for p in probs if rows[i])
        for rank in (floor(position), ceil(position))
    }
    exact: dict[tuple[int, int], float] = {}
    while open_:
        brackets = {}
        for (i, rank), (within, wider) in open_.items():
            brackets[i, rank] = within.closer(rank, wider * (within.rows * 2 / accuracy + 2))
        large = {}
        for key, (within, wider) in open_.items():
            expected = within.rows * (wider * 4 / accuracy + 2 / grid)
            b = brackets[key]
            if expected > held and b.low < b.high and (b.low, b.high) != (within.bracket.low, within.bracket.high):
                large[key] = b
        if large:
            again = dict(zip(set(large.values()), _probe(values, list(set(large.values())), grid, accuracy)))
            for key, b in large.items():
                inside = again[b].under <= key[1] < again[b].under + again[b].rows
                open_[key] = (again[b], 1) if inside else (open_[key][0], open_[key][1] * _WIDER)
            continue
        exact |= _count(values, brackets)
        open_ = {key: (within, wider * _WIDER) for key, (within, wider) in open_.items() if key not in exact}
    result: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for i, c in enumerate(columns):
        for j, position in enumerate(p * (rows[i] - 1) for p in probs if rows[i]):
            low, high = exact[i, floor(position)], exact[i, ceil(position)]
            result[c][j] = low if low == high else low + (high - low) * (position - floor(position))
    return result


def _size(accuracy: int) -> int:
    """Size of a sketch for a rank error of one in ``accuracy``; the constants are those of the sketch's error bound."""
    return min(max(ceil((2.296 * accuracy) ** (1 / 0.9021)), 8), 65535)


def _steps(sketch: Column, grid: int) -> Column:
    steps = ", ".join(f"{i / grid!r}D" for i in range(grid + 1))
    return F.kll_sketch_get_quantile_double(sketch, F.expr(f"array({steps})"))


def _found(row, brackets: list[_Bracket]) -> list[_Probed]:
    out = []
    for k, b in enumerate(brackets):
        values = list(row[f"p{k}"] or [])
        if values:
            values[0], values[-1] = row[f"a{k}"], row[f"z{k}"]
        out.append(_Probed(b, row[f"u{k}"], row[f"n{k}"] or 0, values))
    return out


def _merged(stored: DataFrame, brackets: list[_Bracket], grid: int) -> list[_Probed]:
    aggregates = []
    for i in range(len(brackets)):
        sketch = F.kll_merge_agg_double(F.col(f"s{i}"))
        aggregates += [
            F.lit(0).alias(f"u{i}"), F.sum(f"n{i}").alias(f"n{i}"), F.min(f"a{i}").alias(f"a{i}"), F.max(f"z{i}").alias(f"z{i}"),
            F.when(F.sum(f"n{i}") > 0, _steps(sketch, grid)).alias(f"p{i}"),
        ]
    return _found(stored.agg(*aggregates).first(), brackets)


def _probe(values: DataFrame, brackets: list[_Bracket], grid: int, accuracy: int) -> list[_Probed]:
    """Per bracket: rows under it and in it, and its values at the steps of the grid."""
    aggregates = []
    for k, b in enumerate(brackets):
        own = F.when(b.holds(), F.col(f"v{b.column}"))
        sketch = F.kll_sketch_agg_double(own, F.lit(_size(accuracy)))
        aggregates += [
            F.count(F.when(b.under(), 1)).alias(f"u{k}"),
            F.count(own).alias(f"n{k}"),
            F.min(own).alias(f"a{k}"),
            F.when(F.count(own) > 0, _steps(sketch, grid)).alias(f"p{k}"),
            F.max(own).alias(f"z{k}"),
        ]
    return _found(values.agg(*aggregates).first(), brackets)


def _count(values: DataFrame, brackets: dict[tuple[int, int], _Bracket]) -> dict[tuple[int, int], float]:
    """The values of the wanted ranks that lie in their brackets.

    Every row is counted at most once a column: by its value if a bracket of the column holds it, else by the gap it is in.
    """
    columns = sorted({i for i, _ in brackets})
    entries, ranks = [], []
    for i in columns:
        joined: list[list[float]] = []
        for low, high in sorted((b.low, b.high) for (j, _), b in brackets.items() if j == i):
            if joined and low <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], high)
            else:
                joined.append([low, high])
        v = F.col(f"v{i}")
        zone = F.when(v.isNull(), None)
        for z, (low, high) in enumerate(joined):
            zone = zone.when(v < low, 2 * z).when(v <= high, 2 * z + 1)
        # rows above the last bracket are not asked about
        entries.append(F.struct(F.lit(i).alias("c"), zone.alias("z"), F.when(zone % 2 == 1, v).alias("v")))
        ranks += [F.lit(i), F.array(*[F.lit(r).cast("long") for j, r in sorted(brackets) if j == i])]
    rows = values.select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter("z is not null")
    counts = rows.groupBy("c", "z", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("c").orderBy("z", "v").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("upto", upto).withColumn("ranks", F.create_map(*ranks)[F.col("c")])
    met = F.filter("ranks", lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    settled = placed.filter("v is not null").select("c", "v", F.explode(met).alias("rank"))
    return {(r.c, r.rank): r.v for r in settled.collect()}
