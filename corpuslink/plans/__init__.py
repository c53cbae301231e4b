"""

``registry.QUERIES`` maps a name to ``(spark_fn, oracle_sql)``; the catalogue
modules register into it on import.
"""
