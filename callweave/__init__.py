"""callweave: call-graph, coupling and module analytics as Spark DataFrame jobs.

Every public function takes DataFrames (plus scalars) and returns DataFrames.
Tables carry a ``project`` column so one job can analyse many code bases at once.
"""

from callweave.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
