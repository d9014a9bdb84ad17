"""Named queries over the driver tables (batch and streaming) with their
SQL oracles."""

from clickflow.plans.registry import REGISTRY, Query, register  # noqa: F401
from clickflow.plans import batch  # noqa: F401  (registers batch queries)
from clickflow.plans import streams  # noqa: F401,E402  (registers streaming queries)
