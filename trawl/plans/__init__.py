"""Registered queries over the sample tables, with their SQL counterparts."""
