"""tickforge: a Spark-native trade analytics engine.

Bronze -> Silver -> Gold -> marts, documents and reports, all as DataFrame /
Spark SQL / Structured Streaming plans.
"""

from .session import get_session

__all__ = ["get_session"]
