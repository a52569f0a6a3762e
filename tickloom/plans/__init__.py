from tickloom.plans import (  # noqa: F401  (each module registers its queries)
    q_sources,
    q_projections,
    q_filters,
    q_joins,
    q_aggregates,
    q_windows,
    q_scalars,
    q_incremental,
)
from tickloom.plans.registry import ORACLE, QUERIES  # noqa: F401
