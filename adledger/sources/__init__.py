"""Sources (raw report scans, test-table adapters) and sinks."""
