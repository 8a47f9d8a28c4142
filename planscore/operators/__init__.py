"""Relational building blocks of the report: filters, rollups, targets, calendar windows."""
