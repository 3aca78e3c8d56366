"""quire: ratings cleaning, profiling and recommendation on Spark.

Every public operator takes DataFrames and returns DataFrames. Column names are
parameters with lower-case canonical defaults (``user_id``, ``isbn``,
``book_rating``, ``item_id``, ``norm``), so nothing is tied to one data set.
"""

from quire.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
