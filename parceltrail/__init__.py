"""Delivery analytics for marketplaces: raw CSV to star schema to delivery KPIs, on Spark."""
