"""Policy, catalog, stages, report and command line."""
