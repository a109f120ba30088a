"""The registered queries: one per operator, over whole tables, with the SQL they must equal."""

from gaugeflow.queries import decoding, keyed, streams, tables  # noqa: F401
from gaugeflow.queries.registry import ORACLES, QUERIES  # noqa: F401
