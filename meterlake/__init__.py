"""meterlake: a PySpark-native analytics engine for smart-meter telemetry.

Every operator is a plain ``DataFrame -> DataFrame`` function. The same
function runs in batch and in Structured Streaming; the work is declared
with the DataFrame API and left to Catalyst/AQE to plan.
"""

from meterlake.config import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
