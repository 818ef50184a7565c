"""Registered queries: stand-in tables, plans and their SQL."""
