"""Operators for building training corpora: one module per operator, each a Spark
job over whole tables.  Nothing outside this subpackage imports it."""
