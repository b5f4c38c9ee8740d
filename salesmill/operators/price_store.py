"""Price sums kept between runs, so that means follow changes without reading all rows again.

The store holds the mergeable sums of `price_groups` by month. A corrected month replaces its sums from its own rows; new
rows are added to the sums of their months. Means and fills come from the stored sums alone, and equal those of one run
over all rows that went in.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmill.functions.numeric import merge_parts
from salesmill.operators.impute import KEYS, Fills, fill_table, global_mean, level_means, measure_fills, price_groups
from salesmill.plans.profiles import Imputation
from salesmill.plans.staging import stage
from salesmill.sinks.monthly import MONTH, MonthlyTable


class PriceStore:
    def __init__(self, spark: SparkSession, path: str, spec: Imputation = Imputation()):
        self.table, self.spec = MonthlyTable(spark, path), spec

    def refresh(self, rows: DataFrame, months: Iterable[int] | None = None) -> list[int | None]:
        """Take the sums of whole months anew from `rows`: of `months`, which filters `rows`, or of all it holds.

        `rows` from a table partitioned by month is read for those months only.
        """
        if months is not None:
            months = list(months)
            rows = rows.where(F.col(MONTH).isin(months))
        return self.table.replace(price_groups(rows, self.spec), months)

    def add(self, rows: DataFrame, mark: int | None = None) -> list[int | None]:
        """Add the sums of new rows to their months, whose earlier sums alone are read. Returns the months.

        With a `mark` (the number of a micro-batch) adding the same rows again replaces the first time. A mark below the
        last one means that the store has seen batches the caller does not know of, which is refused.
        """
        new = stage(price_groups(rows, self.spec), "new-price-groups")
        base = None
        if mark is not None:
            last = self.table.mark()
            if last is not None and mark < last:
                raise ValueError(f"batch {mark} after batch {last}: the store belongs to another run of the stream")
            base = self.table.version(before=mark) if last == mark else None
            if last == mark and base is None:  # the very first batch again
                return self.table.replace(new, self.table.months(), mark)
        months = [r[0] for r in new.select(MONTH).distinct().collect()]
        if self.table.version() is None:
            return self.table.replace(new, mark=mark)
        old = self.table.read(months, base)
        merged = old.unionByName(new).groupBy(*KEYS).agg(
            *[c.alias(n) for n, c in merge_parts().items()], F.sum("n_missing").alias("n_missing")
        )
        return self.table.replace(merged.select(*new.columns), months, mark, base)

    def groups(self, months: Iterable[int | None] | None = None) -> DataFrame:
        return self.table.read(months)

    def means(self, level: int) -> DataFrame:
        """Mean price per key of `level` (1-3), or over all rows (4)."""
        return level_means(self.groups(), level, self.spec) if level < 4 else global_mean(self.groups())

    def fills(self, months: Iterable[int | None] | None = None) -> Fills:
        """Fill values for the rows of `months` (or all); the mean over the whole table is always that of all months."""
        months = None if months is None else list(months)
        groups, every = self.groups(months), months is None or set(months) >= set(self.table.months())
        return measure_fills(stage(fill_table(groups, self.spec, None if every else self.groups()), "fills"))
