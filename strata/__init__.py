"""strata: medallion (bronze / silver / gold) and star-schema operators on Spark.

Every operator is a pure DataFrame function parameterised by column names.
Nothing collects data rows to the driver; the only driver-side values are
scalars (a max key, quantile-free partition counts) and plan-time literals.
"""

from strata.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
