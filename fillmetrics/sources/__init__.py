"""Readers and writers: raw LZ4 JSON lines, file listings, date-partitioned Parquet and marts."""
