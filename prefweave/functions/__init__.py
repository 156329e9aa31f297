"""Column builders. Everything here returns a ``pyspark.sql.Column`` and runs in the JVM."""
