"""Readers for tables, property-graph views and published graph stores."""
