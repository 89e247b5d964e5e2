"""Demand table: wide daily sales to one row per (date, store, item), enriched
with the calendar and the weekly price."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.watch import DemandWatch
from ..vocabulary import ERR_NO_DAY_COLUMNS

DAY_PREFIX = "d_"
ID_COLUMNS = ("item_id", "dept_id", "cat_id", "store_id", "state_id")
SERIES_KEYS = ("store_id", "item_id")
# Columns of ``prices_by_series`` beside its keys.
PRICE_LISTS = ("_weeks", "_prices", "_repeated")
# Columns and order of the demand table.
DEMAND_COLUMNS = ("date", "d", "store_id", "state_id", "item_id", "dept_id", "cat_id",
                  "units_sold", "price", "event_name_1", "event_type_1", "is_promo")


def day_columns(sales: DataFrame) -> list[str]:
    """Names of the day columns, in table order; error when there are none."""
    days = [c for c in sales.columns if c.startswith(DAY_PREFIX)]
    if not days:
        raise ValueError(ERR_NO_DAY_COLUMNS)
    return days


def unpivot_days(sales: DataFrame, lenient: bool = False) -> DataFrame:
    """Wide to long: one row per series and day column, nulls kept.

    Every day column is cast to double first (``stack`` needs one type; a day
    inferred as int next to one inferred as double or string would fail). The
    reshape plans as one Generate, a narrow per-row operator, so it scales with
    the input and never shuffles.
    """
    return explode_cells(day_cells(sales, lenient), day_columns(sales))


def day_cells(sales: DataFrame, lenient: bool = False) -> DataFrame:
    """The ids and, in table order, the day columns as one array ``_cells``: what
    follows has few columns and is compiled, which ``stack`` over thousands is not."""
    cast = "TRY_CAST" if lenient else "CAST"
    cells = ", ".join(f"{cast}(`{c}` AS DOUBLE)" for c in day_columns(sales))
    return sales.selectExpr(*ID_COLUMNS, f"array({cells}) AS _cells")


def explode_cells(rows: DataFrame, days: list[str]) -> DataFrame:
    """One row per cell of ``_cells``, named by ``days``; other columns are kept.
    (The arrays are never empty; the outer form needs no filter for that.)"""
    kept = [c for c in rows.columns if c not in (*ID_COLUMNS, "_cells")]
    placed = rows.select(*ID_COLUMNS, *kept, F.posexplode_outer("_cells").alias("_place", "units_sold"))
    return placed.select(*ID_COLUMNS, F.get(F.lit(days), F.col("_place")).alias("d"), "units_sold", *kept)


def attach_calendar(long_sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Date, week and events by ``d``, left outer.

    No join hint is given: the calendar (one row per day) is small, and Spark
    broadcasts it from its own size checks (file-size estimates, or AQE's exact
    size of the materialised calendar stage) without an extra counting job.
    """
    return long_sales.join(calendar.select("d", "date", "wm_yr_wk", "event_name_1", "event_type_1"),
                           on="d", how="left")


def prices_by_series(prices: DataFrame) -> DataFrame:
    """One row per series: its weeks in order and, in step, their prices; ``_repeated``
    where a week occurs more than once. Bounded by the weeks of a series (when
    price weeks are unique, which ``check_keys`` proves)."""
    listed = F.sort_array(F.collect_list(F.struct(F.col("wm_yr_wk").alias("week"), F.col("sell_price").alias("price"))))
    rows = prices.filter(F.col("wm_yr_wk").isNotNull()).groupBy(*SERIES_KEYS).agg(listed.alias("_listed"))
    weeks = F.col("_listed.week")
    return rows.select(*SERIES_KEYS, weeks.alias("_weeks"), F.col("_listed.price").alias("_prices"),
                       (F.size(F.array_distinct(weeks)) < F.size(weeks)).alias("_repeated"))


def attach_prices(dated: DataFrame, prices: DataFrame) -> DataFrame:
    """The weekly price as ``price``, left outer on (store, item, week).

    Prices are joined as one row per series, on the series alone, and read by
    their week's place in it. So the join needs the partitioning by series that
    the window and the stock fold need as well: sales are exchanged once. A row
    whose week has several prices comes out once for each: they stand side by
    side in the list. No lambda is used, so join, look-up and explode are compiled
    into one stage and the lists are read in place, not copied to each row.
    """
    return look_up_prices(with_price_lists(dated, prices))


def with_price_lists(rows: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join of the series' price lists. They are hashed by task (one row for
    each series), so the rows need no sort."""
    return rows.join(prices_by_series(prices).hint("shuffle_hash"), on=list(SERIES_KEYS), how="left")


def look_up_prices(listed: DataFrame) -> DataFrame:
    """``price`` of each row's week, from the lists beside it."""
    week = F.col("wm_yr_wk")
    at = F.array_position("_weeks", week).cast("int")
    times = F.size("_weeks") - F.size(F.array_remove("_weeks", week))
    found = (F.when(F.col("_repeated") & (at > 0), F.slice("_prices", at, times))
             .otherwise(F.array(F.get("_prices", at - 1))))
    # never empty: the outer form spares the filter that Spark infers, a second look-up
    return listed.select(*(c for c in listed.columns if c not in PRICE_LISTS), F.explode_outer(found).alias("price"))


def enrich_demand(long_sales: DataFrame, calendar: DataFrame, prices: DataFrame,
                  lenient: bool = False, watch: DemandWatch | None = None) -> DataFrame:
    """Attach date, week and events by ``d`` and the weekly price by
    (store, item, week); both joins are left outer. ``watch`` takes figures of
    the rows on their way, without a pass of its own. Sales that carry their
    price lists already (``with_price_lists``) are not joined again."""
    to_date = F.try_to_date if lenient else F.to_date
    watch = watch or DemandWatch.off()
    dated = watch.dated(attach_calendar(watch.sales(long_sales), calendar))
    listed = set(PRICE_LISTS) <= set(dated.columns)
    joined = watch.priced(look_up_prices(dated) if listed else attach_prices(dated, prices))
    date = F.col("date") if dict(calendar.dtypes)["date"] == "date" else to_date(F.col("date"))
    units = F.col("units_sold").cast("double")
    price_col = F.col("price").cast("double")
    if lenient:
        units = F.col("units_sold").try_cast("double")
        price_col = F.col("price").try_cast("double")
    made = {"date": date, "units_sold": units, "price": price_col,
            "is_promo": F.when(F.col("event_name_1").isNotNull(), F.lit(1)).otherwise(F.lit(0))}
    return joined.select(*(made[c].alias(c) if c in made else c for c in DEMAND_COLUMNS))


def build_demand(sales: DataFrame, calendar: DataFrame, prices: DataFrame,
                 lenient: bool = False, watch: DemandWatch | None = None) -> DataFrame:
    """Wide sales + calendar + prices -> the 12-column demand table. The price lists
    are joined to the wide rows, so one row for each series is exchanged, not one
    for each series and day."""
    listed = with_price_lists(day_cells(sales, lenient), prices)
    return enrich_demand(explode_cells(listed, day_columns(sales)), calendar, prices, lenient, watch)
