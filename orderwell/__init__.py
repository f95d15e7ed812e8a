"""Commerce analytics as Spark DataFrame operators.

Every operator is a function ``(tables, **params) -> DataFrame`` over the
normalized order-lifecycle tables described in ``orderwell.sources.contracts``.
"""

__version__ = "0.1.0"
