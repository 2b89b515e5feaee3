"""All registered checks; importing this package fills the registry."""

from millrace.checks import (  # noqa: F401
    aggregation,
    joining,
    jobs,
    layouts,
    projection,
    streams,
    windowing,
    wording,
)
from millrace.checks.registry import ORACLES, QUERIES  # noqa: F401
