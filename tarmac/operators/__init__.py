"""Relational building blocks, independent of the flight model."""

from tarmac.operators.checks import (
    accepted_range, accepted_values, not_null, orphans, same_row_count, summary, unique,
)
from tarmac.operators.dedup import fingerprint, latest_by, latest_where_repeated
from tarmac.operators.joins import fits_broadcast, join_lookup
from tarmac.operators.reshape import both_ends, pivot_fixed, unpivot_named, zip_arrays
from tarmac.operators.summaries import weighted_mean, with_total_level
from tarmac.operators.windows import (
    at_least_median, bottom_k, change_from_previous, in_order, rank_desc, share_of_total, top_k,
    uplift_over,
)

__all__ = [
    "accepted_range", "accepted_values", "at_least_median", "both_ends", "bottom_k",
    "change_from_previous", "fingerprint", "fits_broadcast", "in_order", "join_lookup",
    "latest_by", "latest_where_repeated", "not_null", "orphans", "pivot_fixed", "rank_desc", "same_row_count",
    "share_of_total", "summary", "top_k", "unique", "unpivot_named", "uplift_over",
    "weighted_mean", "with_total_level", "zip_arrays",
]
