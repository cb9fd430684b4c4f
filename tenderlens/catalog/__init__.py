"""Registered queries: each operator run over the given tables, with an SQL equivalent."""

from . import aggregation, chains, cleaning, joining, models, periods, projection, risk, scalars, territory  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
