"""plexus: Spark-native analytics for user-to-user interaction streams.

Layers: raw events (Bronze) -> cleaned events (Silver) -> curated edges (Gold)
-> interaction multigraph -> centralities, communities and dashboard queries.
Every step is a DataFrame -> DataFrame function; only counts and single rows reach the driver.
"""

from plexus.session import build_session, prepare  # noqa: F401

__all__ = ["build_session", "prepare"]
