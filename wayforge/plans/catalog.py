"""All catalog queries."""

from wayforge.plans import evidence_queries, geo_queries, join_queries, listing_queries, log_queries, page_queries, price_queries, stream_queries, text_queries  # noqa: F401
from wayforge.plans.registry import ORACLE_SQL, QUERIES  # noqa: F401
