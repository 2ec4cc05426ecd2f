"""ledgerspark — financial-reporting analytics on Spark.

Every public function takes DataFrames and returns a DataFrame built from
built-in Spark expressions, so Catalyst plans the work and executors run it.
Actions happen only in gates, publishing and the pipeline runner.
"""

from ledgerspark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
