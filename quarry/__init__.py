"""quarry: DataFrame / SQL / Structured Streaming operators for text, tables and streams.

Every public function takes and returns Spark DataFrames; nothing is pulled to the driver
except bounded results (a count, a top-k, a schema).
"""

from quarry.session import get_session, scratch_path, shared_root

__all__ = ["get_session", "scratch_path", "shared_root"]
