"""Inputs: station files (binaryFile), the raw table, and the driver-table proxy."""
