"""keelson: classic statistical learning on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames.  Fits reduce to a
few aggregation jobs over sufficient statistics (Gram matrices, histograms,
class counts); fitted models are small tables or literal expressions that
score batch and streaming frames alike.
"""

from keelson.session import get_session, checkpoint_dir, cut_lineage

__all__ = ["get_session", "checkpoint_dir", "cut_lineage"]
