"""Table scans, sinks and stored models."""
