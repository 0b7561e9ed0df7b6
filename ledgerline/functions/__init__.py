"""Column-level helpers: hash text encoding, null tokens, report formatting."""

from ledgerline.functions.hashing import content_hash_column, python_text
from ledgerline.functions.text import null_tokens_to_null, percent_text, seconds_text

__all__ = ["content_hash_column", "python_text", "null_tokens_to_null", "percent_text", "seconds_text"]
