"""Query plans: fixture views, the registered query catalog, SQL oracles, reports
and the end-to-end workflow."""
