"""Marketplace order marts on Spark: raw landing, star schema, quality gate, metrics, insights."""
