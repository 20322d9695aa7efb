"""Readers: landing-zone CSV files, file listings, link pages, tables, JSON text."""
