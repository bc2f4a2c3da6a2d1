"""Everything registered."""

from tidemark.plans import keyed, rows, streams, timed  # noqa: F401  (registration)
from tidemark.plans.registry import QUERIES, SQL  # noqa: F401
