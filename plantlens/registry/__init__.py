"""The registered queries: each inventory row over the driver tables, with its check in SQL."""
