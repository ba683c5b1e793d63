"""ledgerflow: a PySpark-native extract-load-transform analytics engine.

Layers:
  sources/    landed records, page envelopes, seeds, catalog, run log, schema files
  operators/  schema inference, incremental load + upsert, ranking, data quality,
              cross-vendor conformance
  functions/  Column-level helpers (flags, date math, datetime codecs) and measures
  plans/      the model DAG: staging -> intermediate -> marts -> reporting -> pages
  streaming/  the continuous (Structured Streaming) form of the incremental load
"""

from ledgerflow.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
