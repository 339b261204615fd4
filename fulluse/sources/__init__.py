"""Typed readers, landing with row parity, and the adapter over the TPC-H-like tables."""
