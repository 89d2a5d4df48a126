from tierstone.operators.lookup import (
    completed_only,
    fits_broadcast,
    hot_key_rows,
    hot_keys,
    in_memory_bytes,
    lookup_join,
)
from tierstone.operators.metrics import customer_spend, exact_avg, exact_sum, sales_by
from tierstone.operators.quality import (
    dedupe_by_key,
    fill_defaults,
    flag_quality,
    require_not_null,
)
from tierstone.operators.ranking import dense_rank_global, top_ranked
from tierstone.operators.removed import removed_rows

__all__ = [
    "completed_only",
    "customer_spend",
    "dedupe_by_key",
    "dense_rank_global",
    "fill_defaults",
    "fits_broadcast",
    "flag_quality",
    "hot_key_rows",
    "hot_keys",
    "in_memory_bytes",
    "lookup_join",
    "removed_rows",
    "require_not_null",
    "exact_avg",
    "exact_sum",
    "sales_by",
    "top_ranked",
]
