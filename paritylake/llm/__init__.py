"""Operators for preparing large text corpora (training-data pipelines).

Nothing outside this subpackage imports it; ``__spark_entry__.py`` registers
its queries only when it can be imported.
"""
