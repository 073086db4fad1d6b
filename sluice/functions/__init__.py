"""Column-expression builders.  Nothing here runs Python per row: every function returns a
``pyspark.sql.Column`` made of built-in expressions, so it stays inside whole-stage codegen."""
