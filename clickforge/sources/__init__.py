"""Sources and sinks: the impressions fixture over the driver tables, typed TSV, Parquet steps,
LIBSVM, statistics tables and fitted models (S1-S12)."""
