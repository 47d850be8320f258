"""Built-in Spark functions put together, as SQL expression text.

Feature tables are wide and their columns are generated, so expressions are written as text
for ``selectExpr`` and ``F.expr``: one call into the JVM per column, not one per operator.
Arguments are expressions too; ``ref`` and ``text`` quote names and literals.
"""
