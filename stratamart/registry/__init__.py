"""The named queries and their SQL counterparts, used by the entry point, tests and bench."""
