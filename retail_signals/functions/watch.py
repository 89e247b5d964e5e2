"""Figures of a job's rows, taken by ``DataFrame.observe`` while they are written."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class DemandWatch:
    """Rows on their way to the demand table: sales rows, rows without a calendar
    day, and the rows that each join added (repeated days, repeated price weeks)."""

    def __init__(self, on: bool = True):
        self.on = on
        self.observations: dict[str, Observation] = {}

    @classmethod
    def off(cls) -> DemandWatch:
        return cls(False)

    def _observe(self, df: DataFrame, name: str, *figures: Column) -> DataFrame:
        if not self.on:
            return df
        self.observations[name] = Observation(name)
        return df.observe(self.observations[name], *figures)

    def sales(self, df: DataFrame) -> DataFrame:
        return self._observe(df, "sales", F.count(F.lit(1)).alias("rows"),
                             F.count_if(F.col("units_sold").isNull()).alias("without_units"))

    def dated(self, df: DataFrame) -> DataFrame:
        return self._observe(df, "dated", F.count(F.lit(1)).alias("rows"),
                             F.count_if(F.col("date").isNull()).alias("undated"))

    def priced(self, df: DataFrame) -> DataFrame:
        return self._observe(df, "priced", F.count(F.lit(1)).alias("rows"),
                             F.count_if(F.col("price").isNull()).alias("without_price"))

    def ledger(self, df: DataFrame, repeated: Column) -> DataFrame:
        """``repeated`` marks rows with the date of another row of their series."""
        return self._observe(df, "ledger", F.count(F.lit(1)).alias("rows"), F.count_if(repeated).alias("repeated"))

    def figures(self) -> dict[str, int]:
        """The figures of the passes that have run."""
        got = {name: o.get for name, o in self.observations.items()}
        out = {}
        if "sales" in got:
            out |= {"sales_rows": got["sales"]["rows"], "sales_without_units": got["sales"]["without_units"],
                    "undated_rows": got["dated"]["undated"],
                    "rows_added_by_calendar": got["dated"]["rows"] - got["sales"]["rows"],
                    "rows_added_by_prices": got["priced"]["rows"] - got["dated"]["rows"],
                    "rows_without_price": got["priced"]["without_price"]}
        if "ledger" in got:
            out |= {"ledger_rows": got["ledger"]["rows"], "repeated_dates": got["ledger"]["repeated"]}
        return out
