"""Query plans: stage functions and the registry of named queries."""

from . import queries  # noqa: F401  (registers the panel queries)
from . import report_queries  # noqa: F401  (registers model and report queries)
from . import stats_queries  # noqa: F401  (registers inference queries)
from . import clean_queries  # noqa: F401  (registers cleaning and quality queries)
from . import source_queries  # noqa: F401  (registers source round trips)
