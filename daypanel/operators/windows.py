"""Per-entity window operators.

All specs share ``partitionBy(entity).orderBy(date)`` so Catalyst plans one
Exchange on the entity, one Sort and one Window for every lag and rolling column
together.  After aggregation to (entity, day) grain an entity holds at most one
row per calendar day, so a window partition is bounded by the length of the
calendar, not by the size of the raw data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_LAGS = [1, 7, 14, 28]
DEFAULT_WINDOWS = [7, 14, 28, 60]


def _spec(entity: str, date: str):
    return Window.partitionBy(entity).orderBy(date)


def lag_columns(target: str = "Sales", lags=None, entity: str = "Store",
                date: str = "Date") -> dict[str, Column]:
    """``{target}_Lag_{k}`` = value k rows earlier within the entity (row shift)."""
    w = _spec(entity, date)
    return {f"{target}_Lag_{k}": F.lag(F.col(target), k).over(w) for k in (lags or DEFAULT_LAGS)}


def rolling_columns(target: str = "Sales", windows=None, entity: str = "Store",
                    date: str = "Date", closed: str = "right") -> dict[str, Column]:
    """W02/W03 (closed='right', current row included, min_periods 1) and W04 (closed='left').

    Float path: sliding row frames.  The std is the sample std, so a one-row
    frame gives NULL.
    """
    base = _spec(entity, date)
    out = {}
    for w in (windows or DEFAULT_WINDOWS):
        frame = base.rowsBetween(-(w - 1), 0) if closed == "right" else base.rowsBetween(-w, -1)
        out[f"{target}_RollingMean_{w}"] = F.avg(F.col(target)).over(frame)
        out[f"{target}_RollingStd_{w}"] = F.stddev_samp(F.col(target)).over(frame)
    return out


def rolling_exact_inputs(target: str = "Sales", scale: int = 2) -> dict[str, Column]:
    """Row-wise inputs of the exact rolling statistics, projected once before the window:
    x and x^2 as decimals (a frame would otherwise re-evaluate them for every offset).

    A value that has more than ``scale`` digits after the point ends the job: rounding it
    would give wrong statistics without a word.  Such targets take the float path.
    """
    x = F.col(target).cast("double")
    xd = F.col(target).cast(f"decimal(18,{scale})")
    lost = F.raise_error(F.format_string(f"{target} has more than {scale} decimal places: %s", x.cast("string")))
    xd = F.when(x.isNull() | (xd.cast("double") == x), xd).otherwise(lost.cast(f"decimal(18,{scale})"))
    return {"_rx": xd, "_rx2": xd * xd}


def rolling_exact_sums(target: str = "Sales", entity: str = "Store", date: str = "Date") -> dict[str, Column]:
    """Running sums of x and x^2 and the count, up to the current row (needs ``rolling_exact_inputs``)."""
    w = _spec(entity, date).rowsBetween(Window.unboundedPreceding, 0)
    return {"_s1": F.sum("_rx").over(w), "_s2": F.sum("_rx2").over(w), "_sn": F.count(F.col(target)).over(w)}


def _exact_offsets(window: int, closed: str) -> tuple[int, int]:
    """Rows back to the running sums at the end of a frame and just before it."""
    return (0, window) if closed == "right" else (1, window + 1)


def rolling_exact_shifts(windows=None, entity: str = "Store", date: str = "Date", closed: str = "right") -> dict[str, Column]:
    """The running sums of each earlier row that a frame needs, every one taken once."""
    spec = _spec(entity, date)
    offs = sorted({o for w in (windows or DEFAULT_WINDOWS) for o in _exact_offsets(w, closed)} - {0})
    return {f"{c}_{o}": F.lag(c, o).over(spec) for o in offs for c in ("_s1", "_s2", "_sn")}


def rolling_exact_frames(windows=None, closed: str = "right", scale: int = 2) -> dict[str, Column]:
    """S1, S2 and N of each frame, differences of two running sums (needs ``rolling_exact_shifts``)."""
    zero = {"_s1": F.lit(0).cast(f"decimal(28,{scale})"), "_s2": F.lit(0).cast(f"decimal(38,{2 * scale})"), "_sn": F.lit(0)}

    def at(c: str, off: int) -> Column:
        return F.coalesce(F.col(c if off == 0 else f"{c}_{off}"), zero[c])

    out = {}
    for w in (windows or DEFAULT_WINDOWS):
        hi, lo = _exact_offsets(w, closed)
        out.update({f"_f{c[2:]}_{w}": at(c, hi) - at(c, lo) for c in ("_s1", "_s2", "_sn")})
    return out


def rolling_exact_columns(target: str = "Sales", windows=None, scale: int = 2) -> dict[str, Column]:
    """W02-W04 from exact running DECIMAL sums, O(1) work per row and window.

    A frame of w rows is the difference of the running sum here and that of w rows before.
    Every sum is built once, in the Window operator of the lags; the earlier ones are shifts
    of it, in a second Window operator over the same sorted rows.  A sliding frame would re-aggregate all w rows
    for every row instead.
    Decimal differences are exact, so the result is bit-identical to summing
    each frame, and a re-executed task reproduces identical features.
    mean = S1 / N, var = (N * S2 - S1 * S1) / (N * (N - 1)) for N > 1; the difference, in
    which large values would cancel, is taken in decimals before any cast to double.
    Needs the columns of ``rolling_exact_frames`` on the frame.
    """
    cols = {}
    for w in (windows or DEFAULT_WINDOWS):
        d1, n = F.col(f"_f1_{w}"), F.col(f"_fn_{w}")
        s1, s2 = d1.cast(f"decimal(18,{scale})"), F.col(f"_f2_{w}").cast(f"decimal(27,{2 * scale})")
        # in units of the last digit squared, a whole number
        spread = ((n.cast("decimal(6,0)") * s2 - s1 * s1).cast(f"decimal(38,{2 * scale})") * F.lit(10 ** (2 * scale))).cast("decimal(38,0)")
        var = spread.cast("double") / F.nullif((n * (n - 1)).cast("double"), F.lit(0.0))
        cols[f"{target}_RollingMean_{w}"] = d1.cast("double") / F.nullif(n, F.lit(0))
        cols[f"{target}_RollingStd_{w}"] = F.when(n > 1, F.sqrt(var) / F.lit(float(10 ** scale)))
    return cols


def with_rolling_exact(df: DataFrame, target: str = "Sales", windows=None, entity: str = "Store", date: str = "Date",
                       closed: str = "right", scale: int = 2, beside: dict[str, Column] | None = None) -> DataFrame:
    """Appends the exact rolling columns, and the window columns ``beside`` in the operator of the sums.

    The statistics end in a Window operator that takes each from its own row, which a filter
    can't pass: without it a filter on them would compute them all again, in one method too
    long for the JVM to compile.  Columns nobody reads still go, with their shifts.
    """
    spec = _spec(entity, date)
    stats = rolling_exact_columns(target, windows, scale)
    out = (df.withColumns(rolling_exact_inputs(target, scale))
           .withColumns({**(beside or {}), **rolling_exact_sums(target, entity, date)})
           .withColumns(rolling_exact_shifts(windows, entity, date, closed))
           .withColumns(rolling_exact_frames(windows, closed, scale))
           .withColumns(stats))
    out = out.select(*df.columns, *(beside or {}), *stats)
    return out.withColumns({c: F.lag(c, 0).over(spec) for c in stats})


def add_lags(df: DataFrame, target: str = "Sales", lags=None, entity: str = "Store",
             date: str = "Date") -> DataFrame:
    return df.withColumns(lag_columns(target, lags, entity, date))


def add_rolling(df: DataFrame, target: str = "Sales", windows=None, entity: str = "Store",
                date: str = "Date", closed: str = "right", exact_scale: int | None = None) -> DataFrame:
    """W02-W04; with ``exact_scale`` (e.g. 2 for currency) the exact running-sum form."""
    if exact_scale is not None:
        return with_rolling_exact(df, target, windows, entity, date, closed, exact_scale)
    return df.withColumns(rolling_columns(target, windows, entity, date, closed))


def calendar_lag(df: DataFrame, target: str = "Sales", days: int = 7, entity: str = "Store",
                 date: str = "Date", name: str | None = None) -> DataFrame:
    """Value from exactly ``days`` calendar days earlier (NULL if that day is absent).

    A RANGE frame on the day number selects exactly the row at d - k, so it
    shares the entity exchange with the other windows instead of a self join.
    """
    dn = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(entity).orderBy(dn).rangeBetween(-days, -days)
    return df.withColumn(name or f"{target}_CalLag_{days}", F.first(F.col(target)).over(w))


def forward_fill(df: DataFrame, col: str, entity: str = "Store", date: str = "Date") -> DataFrame:
    """Carry the last non-null value forward within the entity."""
    w = _spec(entity, date).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(F.col(col), ignorenulls=True).over(w))


def leak_check_lags(df: DataFrame, target: str = "Sales", lag_col: str = "Sales_Lag_1",
                    entity: str = "Store", date: str = "Date") -> DataFrame:
    """Recompute lag 1 independently (rank self-join) and count disagreements.

    Returns (n_rows, n_mismatch, n_first_not_null); all but n_rows must be 0.
    """
    ranked = df.select(entity, date, target, lag_col,
                       F.row_number().over(_spec(entity, date)).alias("_rn"))
    prev = ranked.select(entity, (F.col("_rn") + 1).alias("_rn"), F.col(target).alias("_prev"))
    j = ranked.join(prev, [entity, "_rn"], "left")
    return j.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col(lag_col).eqNullSafe(F.col("_prev"))).alias("n_mismatch"),
        F.count_if((F.col("_rn") == 1) & F.col(lag_col).isNotNull()).alias("n_first_not_null"),
    )


def trend_vs_recent(daily: DataFrame, metric: str = "rmspe", date: str = "date",
                    lookback: int = 7, factor: float = 1.1) -> DataFrame:
    """today's metric against the mean of the previous ``lookback`` days x factor.

    Runs on a daily table (one row per day), so the un-partitioned window is
    bounded by the number of days.
    """
    w = Window.orderBy(date).rowsBetween(-lookback, -1)
    recent = F.avg(F.col(metric)).over(w)
    return daily.withColumns({
        "recent_mean": recent,
        "degrading": F.coalesce(F.col(metric) > recent * factor, F.lit(False)),
    })
