"""All registered queries; importing the modules fills the registry."""

from slotstream.checks import (  # noqa: F401
    bookings,
    change_data,
    inputs,
    notifications,
    quality,
    records,
    schedule,
    streams,
    warehouse,
)
from slotstream.checks.base import ORACLES, QUERIES  # noqa: F401

# uses the oracle SQL of the modules above
from slotstream.checks import kept  # noqa: F401, E402 isort: skip
