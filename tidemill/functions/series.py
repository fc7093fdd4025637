"""Functions of ordered series, each over the same window specification, so that
Catalyst plans one exchange and one sort however many a query uses."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemill.functions.scalars import ColumnOrName, col, div

DAYS = 252


def by(code: str | None = "code", time: str = "trade_date") -> WindowSpec:
    return Window.partitionBy(*([code] if code else [])).orderBy(time)


def roll(f: Callable[[Column], Column], x: ColumnOrName, n: int, w: WindowSpec) -> Column:
    """f over the last n rows; null until they hold n non-null values."""
    frame = w.rowsBetween(-(n - 1), 0)
    x = col(x)
    return F.when(F.count(x).over(frame) == n, f(x).over(frame))


def lag(x: ColumnOrName, k: int, w: WindowSpec) -> Column:
    return F.lag(col(x), k).over(w)


def diff(x: ColumnOrName, w: WindowSpec) -> Column:
    return col(x) - lag(x, 1, w)


def pct_change(x: ColumnOrName, w: WindowSpec, pad: bool = True) -> Column:
    """Relative change from the row before; ``pad`` carries the last value over
    nulls on both sides."""
    x = col(x)
    if not pad:
        return div(x, lag(x, 1, w)) - 1
    now = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return div(now, before) - 1


def momentum(x: ColumnOrName, n: int, w: WindowSpec) -> Column:
    return div(x, lag(x, n, w)) - 1


def rank_pct(x: ColumnOrName, partition: list[ColumnOrName] = ()) -> Column:
    """Share of the non-null values up to x, ties at their mean rank. One exchange
    and one sort serve the rank, the ties and the number of values."""
    x = col(x)
    ordered = Window.partitionBy(*[col(p) for p in partition]).orderBy(x.asc_nulls_last())
    tied = ordered.rangeBetween(Window.currentRow, Window.currentRow)
    every = ordered.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.rank().over(ordered).cast("double") + (F.count(F.lit(1)).over(tied).cast("double") - 1.0) / 2.0
    return F.when(x.isNotNull(), rank / F.count(x).over(every).cast("double"))


def ewm(values: np.ndarray, alpha: float) -> np.ndarray:
    """y = y + alpha (x - y) from the first value on; over a gap the old weight
    decays once for each missing row."""
    return pd.Series(values).ewm(alpha=alpha, adjust=False, ignore_na=False).mean().to_numpy()


def with_ewm(df: DataFrame, columns: dict[str, tuple[str, float]], code: str | None = "code", time: str = "trade_date", keep: list[str] | None = None) -> DataFrame:
    """``df`` with new columns: name -> (input, alpha); an input can be one made
    before it. A recurrence has no bounded frame, so that each series is one
    pandas group; a series is as long as its history, not as the table. ``code`` None
    takes the whole frame for one series, which one task then computes."""
    names = list(columns)
    kept = keep or df.columns
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{n}` double" for n in names])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time, kind="stable")
        for name, (source, alpha) in columns.items():
            pdf[name] = ewm(pdf[source].to_numpy(dtype=np.float64, na_value=np.nan), alpha)
        return pdf[[*kept, *names]]

    grouped = df.groupBy(code) if code else df.groupBy(F.lit(1))
    out = grouped.applyInPandas(run, schema)
    # pandas has NaN where Spark has null.
    return out.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})

