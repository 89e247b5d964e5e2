"""Stable anomaly ids."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import ANOMALY_ID_SEPARATOR


def anomaly_id(rule: str | Column, date="date", store="store_id", item="item_id") -> Column:
    """sha256 hex of ``rule|date|store|item``; nulls drop out of the text as in
    ``concat_ws``, so the id of one (rule, date, series) never changes between runs."""
    rule_col = F.lit(rule) if isinstance(rule, str) else rule
    return F.sha2(F.concat_ws(ANOMALY_ID_SEPARATOR, rule_col, F.col(date).cast("string"),
                              F.col(store), F.col(item)), 256)
