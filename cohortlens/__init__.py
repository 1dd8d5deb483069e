"""cohortlens: cohort-analytics operators on Spark DataFrames.

Every public function takes DataFrames plus column names and returns a lazy
DataFrame.  Nothing is collected to the driver except bounded metadata
(for example one row per shuffle partition in the ordered-index path).
"""

from cohortlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
