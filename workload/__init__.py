"""Checked queries over the test tables: each has a Spark form and, where SQL can say it, an SQL twin."""
