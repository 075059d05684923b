"""Sinks: partitioned Parquet zones and the warehouse tables."""
