"""Operators of a large-scale training-data pipeline. Nothing outside this
subpackage imports it; ``__spark_entry__.py`` adds its queries when present."""
