"""Every query of the engine over the demonstration tables, each beside its SQL statement."""

from vitrine.plans.catalog import checks, layers, places, ranking, reports, series, sinks  # noqa: F401
from vitrine.plans.catalog.registry import QUERIES, STATEMENTS  # noqa: F401
