"""Column-expression helpers (JVM-side, codegen friendly)."""

from clickforge.functions.hashing import md5_bucket, md5_bucket_sql
from clickforge.functions.scalar import (
    label_recode, natural_log, rounded, safe_divide, SENTINEL_NULL, SENTINEL_RARE,
)

__all__ = ["md5_bucket", "md5_bucket_sql", "label_recode", "natural_log", "rounded",
           "safe_divide", "SENTINEL_NULL", "SENTINEL_RARE"]
