"""cohortlens — Spark-native cleaning, cohort selection and privacy/fidelity
audits for tabular (health-style) data.

Every public operator takes DataFrames and returns a DataFrame. Operators are
lazy unless their docstring says they run a small action (``fit_*`` helpers that
collect O(columns) statistics, never data).
"""

from cohortlens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
__version__ = "0.1.0"
