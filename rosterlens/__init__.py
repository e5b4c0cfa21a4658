"""rosterlens: profile-record analytics on Spark DataFrames.

Layers:
  functions/  column expressions (text, numbers, statistics)
  operators/  generic DataFrame operators (dedupe, explode, keys, aggregates)
  sources/    CSV landing, fixture adapter, table reads, sinks
  plans/      the domain plans: cleaning, modelling, reports, explorer, ETL job
  streaming/  incremental landing of a CSV drop folder
"""

from rosterlens.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
