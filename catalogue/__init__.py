"""Registered queries over the generated test tables, and their SQL counterparts."""
