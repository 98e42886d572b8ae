"""airwave: a Spark-native engine that turns raw radio play logs into clean,
enriched and de-duplicated tables, plus the reports built on them.

Everything is a lazy DataFrame plan: scalar cleaning is native Column
expressions, lookups are joins, the artist matcher is a blocked similarity
join plus round-based clustering, and reports are aggregations.
"""

from airwave.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
