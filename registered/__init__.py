"""Registered queries: the library's operators over the provided tables, with SQL oracles."""
