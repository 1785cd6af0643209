"""Sources and sinks: profile and SQL scans, latest partition, text lists, writers."""
