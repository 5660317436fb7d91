"""Running sums and maxima inside groups of any size. Null is a key and a value like any other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys where null equals null; the columns of the left, then those of the right that are no keys."""
    mine = {k: f"_right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(mine)
    on = None
    for k, other in mine.items():
        same = F.col(k).eqNullSafe(F.col(other))
        on = same if on is None else on & same
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*mine.values())


class Ranged:
    """The rows of a table in the order of some columns inside groups, split by ranges and written.

    A large group lies in many partitions; each part is run through by itself and then corrected by what the parts of the
    group before it come to (one row a part).
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], parts: int | None = None):
        self.keys, self.order, self.columns = list(keys), list(order), df.columns
        by = [*keys, *order]
        ranged = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
        self.rows = cut(ranged.withColumn("_part", F.spark_partition_id()))

    def run(
        self, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None, own_row: bool = True,
        totals: dict[str, Column] | None = None,
    ) -> "Ranged":
        """Add sums and maxima of expressions over the rows of the group so far. `own_row` says whether the row itself counts.
        A maximum over nothing is null. `totals` are sums over the whole group."""
        keys, sums, maxima = self.keys, sums or {}, maxima or {}
        total = {n: F.sum(c) for n, c in sums.items()} | {n: F.max(c) for n, c in maxima.items()}
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        whole = totals or {}
        parts = self.rows.groupBy(*keys, "_part").agg(
            *(c.alias(f"_t_{n}") for n, c in total.items()), *(F.sum(c).alias(f"_t_{n}") for n, c in whole.items()))
        shifts = parts.select(*keys, "_part", *(F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in sums),
                              *(F.max(f"_t_{n}").over(before).alias(f"_b_{n}") for n in maxima),
                              *(F.sum(f"_t_{n}").over(Window.partitionBy(*keys)).alias(n) for n in whole))
        inside = Window.partitionBy(*keys, "_part").orderBy(*self.order).rowsBetween(Window.unboundedPreceding, 0 if own_row else -1)
        found = null_safe_join(self.rows.withColumns({f"_i_{n}": c.over(inside) for n, c in total.items()}), shifts, [*keys, "_part"])
        done = {n: F.coalesce(F.col(f"_i_{n}"), F.lit(0)) + F.coalesce(F.col(f"_b_{n}"), F.lit(0)) for n in sums}
        done |= {n: F.greatest(f"_i_{n}", f"_b_{n}") for n in maxima}
        return self._with(found.select(*self.rows.columns, *whole, *(c.alias(n) for n, c in done.items())), [*whole, *done])

    def add(self, name: str, value: Column) -> "Ranged":
        return self._with(self.rows.withColumn(name, value), [name])

    def _with(self, rows: DataFrame, names: list[str]) -> "Ranged":
        other = object.__new__(Ranged)
        other.keys, other.order, other.columns, other.rows = self.keys, self.order, [*self.columns, *names], rows
        return other

    def table(self) -> DataFrame:
        return self.rows.select(*self.columns)
