"""Small name helpers, and expressions as SQL text.

An expression here is a string for ``selectExpr`` / ``F.expr``. Catalyst sees the same tree
as from the Column API, while building it costs one call into the JVM per output column
instead of one per operator.
"""
