"""bourse: order matching and trade analytics as plain Spark DataFrame functions.

Every operator takes and returns DataFrames; the same functions serve batch
jobs and Structured Streaming micro-batches.
"""

from bourse.session import local_session, scratch_path, shared_dir
from bourse import schemas

__all__ = ["local_session", "scratch_path", "shared_dir", "schemas"]
