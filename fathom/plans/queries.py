"""All queries of the library and their DuckDB twins."""

from fathom.plans import filter_queries, join_queries, source_queries  # noqa: F401  they register their queries
from fathom.plans.filter_queries import flagship  # noqa: F401
from fathom.plans.registry import QUERIES, SQL  # noqa: F401
