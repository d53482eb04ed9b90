"""dimweave: dimensional-modelling and behavioural-analytics operators on Spark.

Every operator is a pure function from DataFrames (plus parameters) to a
DataFrame.  IO lives at the edges (``dimweave.sources``), streaming wrappers in
``dimweave.streaming`` and the registered, oracle-checked queries in
``dimweave.plans``.
"""

from dimweave.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
