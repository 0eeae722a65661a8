"""Readers of the raw inputs: registries, filings, facts, tables, prices and news."""
