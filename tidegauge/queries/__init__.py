from tidegauge.queries import fleet, metrics, plans, statements, streams  # noqa: F401
from tidegauge.queries.registry import ORACLES, QUERIES  # noqa: F401
