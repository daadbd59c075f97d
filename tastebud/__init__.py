"""tastebud — recommendation analytics as Spark DataFrame operators.

Catalogue preparation, implicit interactions, per-user splitting and sampling,
collaborative filtering (Spark ML ALS), content scoring over item vectors,
ranking metrics, data-quality diagnostics and per-user reports.  Every operator
is a ``DataFrame -> DataFrame`` function whose work runs on Spark executors.
"""

from tastebud.session import checkpoint_dir, get_spark, materialize, ship_package  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir", "materialize", "ship_package"]
