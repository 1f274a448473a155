"""DataFrame operators: matching, measures, profile and cells, catalog, clean-up, ML."""
