"""trendspark: mention-trend analytics on Spark.

Measures how often known items (any list of names) are mentioned in a
stream of text posts and relates that to daily popularity metrics.
Every operator takes and returns ordinary DataFrames; column names are
parameters so the same code runs on posts, documents or any table.
"""

from trendspark.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
