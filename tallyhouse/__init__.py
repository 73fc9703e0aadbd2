"""Retail sales: flat records to a star schema, report marts and reports."""
