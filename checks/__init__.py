"""The registered queries, their fixtures and their SQL oracles."""
