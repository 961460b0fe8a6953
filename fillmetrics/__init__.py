"""fillmetrics: trade-fill analytics on PySpark DataFrames.

Raw exchange fills are normalised into one date-partitioned Parquet table, summarised into small tables
("marts"), and queried through functions that take and return DataFrames.
"""

from fillmetrics.plans.analytics import FillAnalytics
from fillmetrics.plans.pipeline import PipelineConf, run_pipeline
from fillmetrics.plans.validation import validate

__all__ = ["FillAnalytics", "PipelineConf", "run_pipeline", "validate"]
