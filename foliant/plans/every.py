"""All queries and their SQL."""

from foliant.plans import elements, gate, scores, store  # noqa: F401  they add theirs
from foliant.plans.catalogue import ORACLES, QUERIES  # noqa: F401
