"""Sources and sinks: files (CSV, parquet), JDBC, and the adapter that
derives match tables from the TPC-H-like driver tables."""
