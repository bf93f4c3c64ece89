"""Change logs, tables and the shared test data as inputs; the lake table as output."""
