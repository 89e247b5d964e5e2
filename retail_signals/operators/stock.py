"""Stock ledger under a reorder policy: an ordered fold over each series.

The recurrence (arrivals, then opening stock, reorder check on the opening,
fulfilment capped by stock, closing truncated to a whole number) clamps and
feeds back with a delay, so no window function or associative scan expresses
it. Spark hash-partitions by series and sorts by date inside each partition;
``mapInArrow`` then streams the Arrow batches of a partition through a small
kernel that carries the state of the current series across batch edges. A
series never has to fit in memory, there is no per-group Python call, and no
column is converted to pandas.
"""
from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import StockPolicy
from . import stock_kernel
from .demand import SERIES_KEYS
from .stock_kernel import make_kernel

# Workers receive the kernel by value: no package install needed on executors.
cloudpickle.register_pickle_by_value(stock_kernel)

LEDGER_COLUMNS = ("date", "store_id", "state_id", "item_id", "dept_id", "cat_id", "demand",
                  "forecast_units", "opening_stock", "replenished_qty", "fulfilled_qty",
                  "closing_stock", "stockout_flag", "fulfillment_rate")


def prepared_rows(frame: DataFrame) -> DataFrame:
    """``demand`` (null units count as 0) and a forecast that is never null or zero."""
    demand = F.coalesce(F.col("units_sold").cast("double"), F.lit(0.0))
    fc = F.col("forecast_units")
    return (frame
            .withColumn("demand", demand)
            .withColumn("forecast_units",
                        F.when(fc.isNull() | (fc == 0.0), F.col("demand")).otherwise(fc)))


def with_outcome(folded: DataFrame) -> DataFrame:
    """Fulfilment, closing stock and flags of rows that have their opening stock."""
    opening = F.col("opening_stock").cast("double")
    filled = F.least(opening, F.col("demand"))
    return (folded
            .withColumn("fulfilled_qty", filled)
            .withColumn("closing_stock",
                        F.floor(F.greatest(F.lit(0.0), opening - F.col("fulfilled_qty")))
                        .cast("int"))
            # Spark orders NaN above every number; the ledger's comparisons follow
            # IEEE (a NaN demand is never above the fill, nor above zero)
            .withColumn("stockout_flag",
                        F.when(~F.isnan("demand") & (F.col("demand") > F.col("fulfilled_qty")), 1)
                        .otherwise(0))
            .withColumn("fulfillment_rate",
                        F.when(~F.isnan("demand") & (F.col("demand") > 0),
                               F.col("fulfilled_qty") / F.col("demand"))
                        .otherwise(F.lit(1.0))))


def project_stock(frame: DataFrame, policy: StockPolicy | None = None,
                  partitioned_by_series: bool = False) -> DataFrame:
    """Stock ledger for every series of ``frame``.

    ``frame`` needs date, store_id, item_id, units_sold and forecast_units
    (already coalesced with the units); every other column is carried through.
    Null units count as zero demand; a zero or missing forecast is replaced by
    the demand. Pass ``partitioned_by_series=True`` when the frame comes from
    :func:`with_baseline`, whose exchange the fold then reuses.
    """
    policy = policy or StockPolicy()
    prepared = prepared_rows(frame)
    if not partitioned_by_series:
        prepared = prepared.repartition(*SERIES_KEYS)
    prepared = prepared.sortWithinPartitions(*SERIES_KEYS, "date")
    schema = T.StructType(prepared.schema.fields + [
        T.StructField("opening_stock", T.IntegerType(), False),
        T.StructField("replenished_qty", T.IntegerType(), False),
    ])
    kernel = make_kernel((policy.initial_stock, policy.reorder_point, policy.reorder_qty,
                          policy.lead_rows))
    folded = prepared.mapInArrow(kernel, schema)
    return with_outcome(folded)


def inventory_table(ledger: DataFrame) -> DataFrame:
    """The 14 columns of the stored inventory table."""
    return ledger.select(*LEDGER_COLUMNS)
