"""Input views, audit suites and the registered queries with their SQL."""
