from tabloom.functions.columns import (
    compact,
    hash_bucket,
    hash_order,
    is_missing,
    is_nan,
    key_digest,
    numeric_columns,
    quoted,
    text_columns,
    valid_number,
    vector_item,
)

__all__ = [
    "compact",
    "hash_bucket",
    "hash_order",
    "is_missing",
    "is_nan",
    "key_digest",
    "numeric_columns",
    "quoted",
    "text_columns",
    "valid_number",
    "vector_item",
]
