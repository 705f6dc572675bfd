"""Query plans: the registered queries and their oracle SQL."""

from .catalog import registry  # noqa: F401
from .oracle import oracle_queries  # noqa: F401
