"""Mobile-app analytics on Spark.

Nested product-event and crash exports in; deduplicated fact tables, daily
rollups, install attribution, cohort tables and an app-health table out.
Every step is a function from DataFrame to DataFrame or Column to Column.
"""

from pulsegrain.config import MeasureSpec, ParamSpec, Settings
from pulsegrain.windows import DateWindow, Run

__all__ = ["DateWindow", "MeasureSpec", "ParamSpec", "Run", "Settings"]
