"""The library's queries on the TPC-H-like test tables, and their SQL oracles."""
