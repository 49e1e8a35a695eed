"""Series tails: the last rows of every series at the end of each period.

A run needs the rows of each series before its window for the first returns and
averages. Reading them from gold would scan all history, so a table keeps, for each
quarter boundary (``as_of``), the last 19 rows of each series before it. A run
reads the tail of the nearest boundary and gold from there on: a quarter of gold
at most where runs follow each other.

A row serves the boundaries from the first one after its day up to the one before
its 19th later row's: one ``lead`` gives all of them, however sparse a series is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.gold import GRAIN, LONG_WINDOW, SERIES, look_back
from barlake.sinks.snapshots import SnapshotTable

AS_OF = "as_of"
PERIOD_MONTHS = 3
ROWS = LONG_WINDOW - 1


def floor_day(day: dt.date) -> dt.date:
    """The boundary on or before a day."""
    return dt.date(day.year, (day.month - 1) // PERIOD_MONTHS * PERIOD_MONTHS + 1, 1)


def next_day(boundary: dt.date) -> dt.date:
    month = boundary.month - 1 + PERIOD_MONTHS
    return dt.date(boundary.year + month // 12, month % 12 + 1, 1)


def _boundary_after(day: Column) -> Column:
    month = (F.month(day) - 1) - F.pmod(F.month(day) - 1, F.lit(PERIOD_MONTHS)) + 1
    return F.add_months(F.make_date(F.year(day), month, F.lit(1)), PERIOD_MONTHS)


def bars_of(gold: DataFrame) -> DataFrame:
    """The columns of gold that later rows are computed from."""
    return gold.select(*GRAIN, "close_price", F.col("volume").cast("double").alias("volume"))


def tails(rows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Tails of the boundaries ``first`` to ``last`` from rows (``bars_of``) that hold,
    per series, all of those from the last boundary before ``first`` on, and 19 before."""
    later = F.lead("trading_date", ROWS).over(Window.partitionBy(*SERIES).orderBy("trading_date"))
    start = F.greatest(_boundary_after(F.col("trading_date")), F.lit(first))
    stop = F.coalesce(_boundary_after(F.col("_later")), F.add_months(F.lit(last), PERIOD_MONTHS))
    steps = F.sequence(start, F.add_months(F.least(stop, F.add_months(F.lit(last), PERIOD_MONTHS)), -PERIOD_MONTHS),
                       F.expr(f"interval {PERIOD_MONTHS} months"))
    served = F.when((start < stop) & (start <= F.lit(last)), steps)
    return rows.withColumn("_later", later).withColumn(AS_OF, F.explode(served)).drop("_later")


class Tails:
    """The tails of a gold table, kept beside it. They name the gold version they
    were made from: where that isn't gold's newest (a run was lost between the two
    switches), they count as absent and are made anew."""

    def __init__(self, gold: SnapshotTable):
        self.gold = gold
        self.table = SnapshotTable(gold.spark, gold.path + "_tails", AS_OF)

    def boundaries(self, version: int | None) -> list[dt.date]:
        now = self.table.current()
        if now is None or version is None or now.note != version:
            return []
        return [dt.date.fromisoformat(k[0]) for k in now.keys()]

    def history(self, start: dt.date) -> DataFrame | None:
        """Each series' last 19 gold rows before ``start``; None without gold."""
        now = self.gold.current()
        if now is None:
            return None
        known = [b for b in self.boundaries(now.version) if b <= start]
        before = (start - dt.timedelta(1)).isoformat()
        if not known:
            return look_back(self.gold.read(None, before), start.isoformat())
        at = max(known).isoformat()
        rows = self.table.read(at, at).drop(AS_OF).unionByName(bars_of(self.gold.read(at, before)))
        return look_back(rows, start.isoformat())

    def update(self, run_days: list[str], before: int | None) -> None:
        """After gold has been published with rows of ``run_days`` on top of version
        ``before``: the tails of all boundaries after the first of them. Gold is
        read from the boundary before it to the end of the run's last period;
        later periods' rows come from their old tails, which hold all that count."""
        now = self.gold.current()
        first_day, last_day = (dt.date.fromisoformat(d) for d in (min(run_days), max(run_days)))
        old = self.boundaries(before)
        known = [b for b in old if b <= floor_day(first_day)]
        if not known:  # none to build on: all boundaries, from all of gold
            days = [k[0] for k in now.keys()]
            rows, mode = bars_of(self.gold.read()), "overwrite"
            first, last = (next_day(floor_day(dt.date.fromisoformat(d))) for d in (min(days), max(days)))
        else:
            at, end = max(known), next_day(floor_day(last_day))
            first, last, mode = next_day(floor_day(first_day)), max(end, *old), "dynamic_overwrite"
            rows = (self.table.read(at.isoformat(), at.isoformat()).drop(AS_OF)
                    .unionByName(bars_of(self.gold.read(at.isoformat(), (end - dt.timedelta(1)).isoformat()))))
            if last > end:
                later = self.table.read(next_day(end).isoformat(), last.isoformat())
                rows = rows.unionByName(later.where(
                    F.col("trading_date") >= F.add_months(AS_OF, -PERIOD_MONTHS)).drop(AS_OF))
        self.table.publish(self.table.stage(tails(rows, first, last), SERIES), mode, now.version)
