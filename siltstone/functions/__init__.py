from siltstone.functions.columns import (
    band,
    flatten_to_strings,
    orderable,
    row_hash,
    share_of_total,
    text_of,
    with_share_of_total,
)

__all__ = [
    "band", "flatten_to_strings", "orderable", "row_hash", "share_of_total", "text_of",
    "with_share_of_total",
]
