"""loanlens — Spark-native credit-risk feature, scoring and profiling engine.

Layout:
  functions/  column-expression helpers (division policies, cleaning, row-wise stats)
  operators/  DataFrame operators (spec roll-ups, latest-row, ordered/rank
              statistics, moments, encoders, target encoding)
  sources/    typed readers, sinks, schemas, column-name sanitising
  plans/      domain plans (application, bureau, previous, POS, installments,
              credit card, full feature build, training, profiling) and the
              registry of checked queries over the driver tables
  streaming/  intentionally empty: the reference has no streaming surface
"""

from loanlens.session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
