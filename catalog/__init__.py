"""The registered queries: inputs derived from the test tables, the queries, and their SQL."""
