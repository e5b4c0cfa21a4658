"""Sources and sinks: CSV landing, the fixture adapter, table reads, writers."""
