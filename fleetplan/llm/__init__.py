"""Operators for large-scale training-data preparation. Nothing outside this
subpackage imports it; ``queries`` and ``oracle`` hold what is registered."""
