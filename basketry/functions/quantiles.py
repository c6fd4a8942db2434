"""Exact quantiles of many columns at once, by bracketing.

A sketch of every column, merged like any aggregate, says between which two values a quantile must lie; counting
says whether it does, and how many values lie between. Only those are looked at one by one. No row is copied for a
column, and nothing is sorted but what lies inside the brackets.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

#: Ranks of a sketch are off by at most one in so many values; brackets reach ``REACH`` times as far on either side.
ACCURACY, REACH = 1000, 4
#: Values between the ends of a bracket that are looked at one by one; above that the bracket is sketched again.
FEW = 50_000


@dataclass
class _Bracket:
    """Where the values of ranks ``first`` and ``last`` (from 0) of a column are: within ``low`` and ``high``."""

    column: str
    first: int
    last: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0

    def holds(self, c: Column) -> Column:
        return (c >= F.lit(self.low)) & (c <= F.lit(self.high))

    @property
    def shares(self) -> list[float]:
        """Shares of the values inside between which the ranks lie for sure, as far as a sketch can tell."""
        off = REACH / ACCURACY
        low, high = (self.first - self.below) / self.inside - off, (self.last + 1 - self.below) / self.inside + off
        return [max(0.0, low), min(1.0, high)]


def _sketch(c: Column, shares: Sequence[float]) -> Column:
    return F.percentile_approx(c, [float(s) for s in shares], ACCURACY)


def exact_points(
    df: DataFrame, columns: Mapping[str, Column], points: Mapping[str, float], also: Sequence[Column] = ()
) -> tuple[dict[str, dict[str, float | None]], Row]:
    """Linearly interpolated quantiles ``points`` of each of ``columns``, and the aggregates ``also`` over the same
    columns by their names, from the first pass.

    Nulls and NaN do not count; a column without values has quantiles None. The result has a number for each
    column and point, which is all that reaches the driver."""
    number = {n: F.when(~F.isnan(e.cast("double")), e.cast("double")) for n, e in columns.items()}
    wide = df.select(*[e.alias(n) for n, e in number.items()])
    shares = sorted({s for p in points.values() for s in (max(0.0, p - REACH / ACCURACY), min(1.0, p + REACH / ACCURACY))})
    sizes = [F.count(F.col(f"`{n}`")).alias(f"n {n}") for n in number]
    sketches = [_sketch(F.col(f"`{n}`"), shares).alias(f"s {n}") for n in number]
    seen = wide.agg(*sizes, *sketches, *also).first()
    brackets: dict[tuple[str, str], _Bracket] = {}
    for n in number:
        size = seen[f"n {n}"]
        for label, p in points.items() if size else ():
            place = p * (size - 1)
            b = brackets[n, label] = _Bracket(n, math.floor(place), math.ceil(place), inside=size)
            low, high = max(0.0, p - REACH / ACCURACY), min(1.0, p + REACH / ACCURACY)
            b.low, b.high = seen[f"s {n}"][shares.index(low)], seen[f"s {n}"][shares.index(high)]
    ends = _settle(wide, list(brackets.values()))
    found: dict[str, dict[str, float | None]] = {n: dict.fromkeys(points) for n in number}
    for (n, label), b in brackets.items():
        lo, hi = ends[id(b)]
        place = points[label] * (seen[f"n {n}"] - 1)
        found[n][label] = lo + (hi - lo) * (place - math.floor(place))
    return found, seen


def _settle(wide: DataFrame, brackets: list[_Bracket]) -> dict[int, tuple[float, float]]:
    """The values of the two ranks of each bracket."""
    open_, ready = list(brackets), []
    while open_:
        counts = []
        for i, b in enumerate(open_):
            c = F.col(f"`{b.column}`")
            counts += [F.count_if(c < F.lit(b.low)).alias(f"b{i}"), F.count_if(b.holds(c)).alias(f"i{i}")]
        row, again = wide.agg(*counts).first(), []
        for i, b in enumerate(open_):
            b.below, b.inside = row[f"b{i}"], row[f"i{i}"]
            if b.first < b.below or b.last >= b.below + b.inside:
                # The sketch was off by more than it says: on that side nothing is known.
                b.low = -math.inf if b.first < b.below else b.low
                b.high = math.inf if b.last >= b.below + b.inside else b.high
                again.append(b)
            elif b.inside <= FEW or b.low == b.high:
                ready.append(b)
            else:
                again.append(b)
        narrow = [b for b in again if b.inside > FEW and b.first >= b.below and b.last < b.below + b.inside]
        if narrow:
            sketches = [_sketch(F.when(b.holds(F.col(f"`{b.column}`")), F.col(f"`{b.column}`")), b.shares).alias(f"s{i}") for i, b in enumerate(narrow)]
            row = wide.agg(*sketches).first()
            for i, b in enumerate(narrow):
                before = (b.low, b.high)
                b.low, b.high = row[f"s{i}"]
                if (b.low, b.high) == before:
                    # One value is most of what is inside; it can be counted, however often it occurs.
                    ready.append(b)
                    again.remove(b)
        open_ = again
    return _values(wide, ready)


def _values(wide: DataFrame, brackets: list[_Bracket]) -> dict[int, tuple[float, float]]:
    """Ranks inside brackets, by counting their values."""
    done = {id(b): (b.low, b.low) for b in brackets if b.low == b.high}
    rest = [b for b in brackets if b.low != b.high]
    if not rest:
        return done
    inside = [F.when(b.holds(F.col(f"`{b.column}`")), F.struct(F.lit(i).alias("i"), F.col(f"`{b.column}`").alias("v"))) for i, b in enumerate(rest)]
    values = wide.select(F.explode(F.array_compact(F.array(*inside))).alias("x")).groupBy("x.i", "x.v").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = values.withColumn("end", F.sum("n").over(upto)).withColumn("start", F.col("end") - F.col("n"))
    ranks = {i: (b.first - b.below, b.last - b.below) for i, b in enumerate(rest)}
    at = F.create_map(*[F.lit(x) for i, r in ranks.items() for x in (i, r[0])]), F.create_map(*[F.lit(x) for i, r in ranks.items() for x in (i, r[1])])
    holds = [(F.col("start") <= m[F.col("i")]) & (m[F.col("i")] < F.col("end")) for m in at]
    for r in ranked.groupBy("i").agg(*[F.max(F.when(h, F.col("v"))).alias(n) for h, n in zip(holds, ("lo", "hi"), strict=True)]).collect():
        done[id(rest[r.i])] = (r.lo, r.hi)
    return done
