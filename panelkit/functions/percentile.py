"""Exact percentiles of a large column without bringing the column together."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sketch's relative accuracy.
ACCURACY = 10_000
#: Values of a bracket that are ranked one by one, once it has shrunk to so many.
RANKED = 10_000


@dataclass
class Bracket:
    """Where the value of a rank lies: `before` rows are at `low` or below it, `inside` rows strictly
    between `low` and `high`. A found value closes the bracket."""

    rank: int
    inside: int
    before: int = 0
    low: float = -math.inf
    high: float = math.inf
    value: float | None = None

    def holds(self):
        x = F.col("_x")
        return (x > self.low) & (x < self.high)

    def narrow(self, a: float, b: float, below: int, at_a: int, between: int, at_b: int) -> None:
        """Take the counts around two values of the bracket into account."""
        place = self.rank - self.before
        if place < below:
            self.high, self.inside = a, below
        elif place < below + at_a:
            self.value = a
        elif place < below + at_a + between:
            self.low, self.high, self.before, self.inside = a, b, self.before + below + at_a, between
        elif place < below + at_a + between + at_b:
            self.value = b
        else:
            seen = below + at_a + between + at_b
            self.low, self.before, self.inside = b, self.before + seen, self.inside - seen


def order_statistics(
    values: DataFrame, ranks: set[int], rows: int, accuracy: int = ACCURACY, ranked: int = RANKED
) -> dict[int, float]:
    """The values of the given ranks, from 0, of column `_x`.

    In each round one pass sketches two values around every rank within its bracket, and one counts
    exactly what lies at, between and outside them. Both values leave the bracket, and what is left
    holds a ten-thousandth or so of its rows, so ties never hold it up and three rounds are enough
    for 10^12 rows. Brackets of `ranked` rows at most are ranked on the driver.
    """
    found = [Bracket(rank, rows) for rank in sorted(ranks)]
    while wide := [b for b in found if b.value is None and b.inside > ranked]:
        margin = 4.0 / accuracy
        sketch = values.agg(*[
            F.percentile_approx(F.when(b.holds(), F.col("_x")), [
                max(0.0, (b.rank - b.before) / b.inside - margin), min(1.0, (b.rank - b.before) / b.inside + margin)
            ], accuracy).alias(f"s{i}")
            for i, b in enumerate(wide)
        ]).first()
        x, counts = F.col("_x"), []
        for i, b in enumerate(wide):
            a, z = sketch[i]
            for part in (x < a, x == a, (x > a) & (x < z), (x == z) & F.lit(z > a)):
                counts.append(F.count_if(b.holds() & part).alias(f"c{len(counts)}"))
        counted = values.agg(*counts).first()
        for i, b in enumerate(wide):
            b.narrow(*sketch[i], *counted[4 * i:4 * i + 4])
    for b in found:
        if b.value is None:
            near = sorted(r[0] for r in values.filter(b.holds()).collect())
            b.value = near[b.rank - b.before]
    return {b.rank: b.value for b in found}


def exact_percentiles(
    df: DataFrame, column: str, wanted: Mapping[str, float], accuracy: int = ACCURACY, ranked: int = RANKED
) -> DataFrame:
    """One row with the interpolated percentiles, one column per entry of `wanted`; null without values.

    `df` is read a few times: pass a written table or a plain scan.
    """
    values = df.select(F.col(column).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    rows = values.count()
    out = {name: F.lit(None).cast("double") for name in wanted}
    if rows:
        places = {name: q * (rows - 1) for name, q in wanted.items()}
        ranks = {r for at in places.values() for r in (math.floor(at), math.ceil(at))}
        known = order_statistics(values, ranks, rows, accuracy, ranked)
        for name, at in places.items():
            low, high = known[math.floor(at)], known[math.ceil(at)]
            out[name] = F.lit(float(low + (high - low) * (at - math.floor(at))))
    return df.sparkSession.range(1).select(*[c.alias(name) for name, c in out.items()])
