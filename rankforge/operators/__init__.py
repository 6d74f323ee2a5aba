"""Reusable table operators (DataFrame in, DataFrame out; nothing collected)."""

from rankforge.operators.bridge import build_bridge, places, rollup_over_bridge  # noqa: F401
from rankforge.operators.calendar import calendar, day_spine, week_dimension  # noqa: F401
from rankforge.operators.hot_keys import degree_sketch, heavy_keys, hot_buckets, with_estimate  # noqa: F401
from rankforge.operators.joins import join_first_available  # noqa: F401
from rankforge.operators.keys import consolidate_keys  # noqa: F401
from rankforge.operators.names import explode_names  # noqa: F401
from rankforge.operators.ranking import is_new_entry, rank_change_columns, rank_delta  # noqa: F401
from rankforge.operators.reports import (  # noqa: F401
    movers_down, movers_up, new_entries, top_k_for, weekly_kpi,
)
from rankforge.operators.topn import (  # noqa: F401
    asc, best_per_key, desc, latest_per_key, number_in_group, top_k_per_group,
)
from rankforge.operators.windows import trailing_window_sum  # noqa: F401
