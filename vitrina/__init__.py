"""Retail business intelligence on Spark: star schema, history, cube, KPIs and mining."""
