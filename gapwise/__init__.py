"""gapwise — click-log analytics and gap-based session features on PySpark.

Everything is a DataFrame -> DataFrame transformation that composes with
``df.transform(...)``; the heavy lifting runs inside Catalyst/Tungsten.
"""

from gapwise.runtime import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
