from tabloom.sources.readers import (
    demo_features,
    load,
    load_csv,
    load_table,
    preview,
    synthetic,
    table_shape,
)

__all__ = [
    "demo_features",
    "load",
    "load_csv",
    "load_table",
    "preview",
    "synthetic",
    "table_shape",
]
