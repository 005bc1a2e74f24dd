"""Operators bound to the benchmark tables: inputs, registered queries and their SQL counterparts."""
