"""Table operators that work on any DataFrame."""

from medallion.operators.dedup import distinct_by_digest, mark_repeated
from medallion.operators.distinct import (
    distinct_counts,
    distinct_state,
    merge_states,
    number_values,
)
from medallion.operators.enrich import enrich_then_total
from medallion.operators.grids import grid_long, pivot_grid, to_long
from medallion.operators.histogram import histogram, histogram_by
from medallion.operators.listing import list_in_order
from medallion.operators.ordering import ntile_global, number_rows, rank_rows, running_total
from medallion.operators.quantiles import exact_quantiles
from medallion.operators.selection import (
    between_inclusive,
    distinct_values,
    first_values,
    latest_rows,
    pick_value,
    value_range,
)

__all__ = [
    "between_inclusive", "distinct_by_digest", "distinct_counts", "distinct_state",
    "distinct_values", "enrich_then_total", "exact_quantiles", "first_values", "grid_long",
    "histogram", "histogram_by", "latest_rows", "list_in_order", "mark_repeated",
    "merge_states", "ntile_global", "number_rows",
    "number_values", "pick_value", "pivot_grid", "rank_rows", "running_total", "to_long",
    "value_range",
]
