"""Column-level helpers: pure expressions, no Python per row."""

from corpuslink.functions.text import (
    fmt_decimal, fmt_int, preview, reference, safe_name, squash_ws, ustrip, wiki_link,
)
from corpuslink.functions.vectors import dot, l2_norm, l2_normalize

__all__ = [
    "fmt_decimal", "fmt_int", "preview", "reference", "safe_name", "squash_ws",
    "ustrip", "wiki_link", "dot", "l2_norm", "l2_normalize",
]
