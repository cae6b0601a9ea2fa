"""Sources (raw CSV scans, the test-data bridge) and sinks."""
