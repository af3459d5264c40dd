"""Lakehouse data operators for PySpark.

Every operator takes and returns DataFrames, batch or streaming, and stays
lazy; Spark plans and runs the work.
"""

from tidewater.session import build_session, drop_staged, fresh_path, shared_dir, staged

__all__ = ["build_session", "drop_staged", "fresh_path", "shared_dir", "staged"]
