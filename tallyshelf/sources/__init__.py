"""Readers, writers, catalog tables and scratch folders."""
