"""stargrain — dimensional-model building blocks on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or returns a
``Column``).  Nothing collects data to the driver; the few operators that
need a result before they can build their plan (``auto_field``,
``cleanse(drop_null_columns=True)``) run one aggregate job whose result has
one row.
"""

from stargrain.session import get_spark, scratch_dir  # noqa: F401
