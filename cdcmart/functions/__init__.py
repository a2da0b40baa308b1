"""Column expressions. Every one is built from Spark's own functions, so it stays
inside generated code; there is no Python UDF anywhere in the package."""
