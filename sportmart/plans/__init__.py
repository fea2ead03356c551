"""Star-schema models, check suites, the batch load and the query catalogue."""
