"""All registered queries. Importing a module of this package registers its queries."""

from tabloom.plans import (  # noqa: F401
    balance_queries,
    feature_queries,
    metric_queries,
    model_queries,
    preprocessing_queries,
    profile_queries,
    source_queries,
    tuning_queries,
)
from tabloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
