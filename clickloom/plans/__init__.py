"""Ready queries by name: each takes a session and a folder of parquet tables."""

from clickloom.plans import alerts, basics, products, traffic

QUERIES = {**traffic.QUERIES, **alerts.QUERIES, **products.QUERIES, **basics.QUERIES}
