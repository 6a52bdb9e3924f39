"""Named queries (Spark plan + DuckDB oracle) covering the operator inventory."""

from loam.plans.registry import REGISTRY, Query, register  # noqa: F401
from loam.plans import q_basic, q_eval, q_features, q_io, q_models, q_reports, q_search, q_series, q_split, q_state, q_text, q_vector  # noqa: F401,E402
