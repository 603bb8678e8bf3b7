"""The four incident questions (and their variants) as Spark plans.

``roster.QUERIES`` maps each query key to ``(spark, sf_dir) -> DataFrame``;
``roster.ORACLE`` holds the equivalent SQL for an independent engine."""
