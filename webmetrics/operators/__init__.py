"""DataFrame -> DataFrame operators (ingest, routing, enrichment, rollups, reports)."""
