"""Named queries over the driver tables, each with the SQL that must give the same rows."""

from tidemark.catalog import fraud, prices, streams, trees, trips  # noqa: F401
from tidemark.catalog.registry import ORACLES, QUERIES  # noqa: F401
