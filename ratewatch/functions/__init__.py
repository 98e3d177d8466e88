"""Expressions as Spark SQL text, for ``selectExpr`` and ``expr``.

Text composes as freely as columns, and a whole expression reaches the JVM in
one call instead of one call per function.
"""
