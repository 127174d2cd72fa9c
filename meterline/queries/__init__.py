from meterline.queries import (  # noqa: F401  (importing registers)
    q_aggregates,
    q_columns,
    q_joins,
    q_models,
    q_nested,
    q_quality,
    q_reports,
    q_sources,
    q_suites,
    q_tables,
)
from meterline.queries.registry import REGISTRY  # noqa: F401
