"""DataFrame -> DataFrame building blocks.

None of them collects rows to the driver or leaves the DataFrame API; the
only driver round trips are bounded: a header line, a row count."""

from blotter.operators.aggregates import count_by, decode_codes, duplicate_keys
from blotter.operators.distance import distance_by_group
from blotter.operators.filters import (
    code_filter,
    drop_malformed,
    drop_null_island,
    prefix_filter,
    require_not_null,
    year_filter,
)
from blotter.operators.heavy import heavy_keys, join_heavy
from blotter.operators.joins import (
    STRATEGIES,
    geo_enrich,
    join_with_strategy,
    keep_first,
    semi_join_keys,
)
from blotter.operators.naming import rename_strict, trim_column_names
from blotter.operators.ranking import top_k_groups, top_k_per_group
from blotter.operators.nearby import geo_near
from blotter.operators.sketches import answered, rolled_up, sketched
from blotter.operators.temporal import asof_join, interval_join, running_total

__all__ = [
    "answered",
    "rolled_up",
    "sketched",
    "asof_join",
    "geo_near",
    "heavy_keys",
    "interval_join",
    "join_heavy",
    "running_total",
    "STRATEGIES",
    "code_filter",
    "count_by",
    "decode_codes",
    "distance_by_group",
    "drop_malformed",
    "drop_null_island",
    "duplicate_keys",
    "geo_enrich",
    "join_with_strategy",
    "keep_first",
    "prefix_filter",
    "rename_strict",
    "require_not_null",
    "semi_join_keys",
    "top_k_groups",
    "top_k_per_group",
    "trim_column_names",
    "year_filter",
]
