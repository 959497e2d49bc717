"""Column-level helpers (salt buckets, null guards, text rendering)."""
from rankwise.functions.columns import NULL_TOKEN, not_null, salt_bucket, split_line, text_line

__all__ = ["NULL_TOKEN", "not_null", "salt_bucket", "split_line, text_line"]
