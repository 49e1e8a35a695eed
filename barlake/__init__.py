"""barlake — a Spark-native daily-bar lakehouse.

Layers: landed bars -> bronze -> silver -> gold -> star schema (dims + daily /
monthly / yearly facts) -> integrity checks and BI reports, with declarative
data contracts evaluated as Spark aggregations. Every operator is a pure
``DataFrame -> DataFrame`` function built from Catalyst expressions.
"""

from barlake.session import build_session, checkpoint_dir, lake_root

__all__ = ["build_session", "checkpoint_dir", "lake_root"]
