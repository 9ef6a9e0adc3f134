"""Payments analytics on Spark: typed and flagged tables, as-of rates, an enriched fact, an hourly cube."""
