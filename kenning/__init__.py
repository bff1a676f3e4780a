"""kenning — who is interested in what, computed from workplace messages on Spark.

Every operator is a ``DataFrame -> DataFrame`` (see ``kenning.operators``) or a
``Column -> Column`` (see ``kenning.functions``) built from native Spark SQL
expressions, so whole-stage codegen covers the hot path and no Python UDF runs
per row.
"""

__all__ = ["session", "config"]
