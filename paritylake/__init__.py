"""paritylake — Spark-native table parity and migration checks.

Every operator takes DataFrames (or a table rule) and returns DataFrames:
violations stay distributed, only small check summaries are ever collected.
"""

from paritylake.session import get_spark, ensure_session, scratch_dir

__all__ = ["get_spark", "ensure_session", "scratch_dir"]
