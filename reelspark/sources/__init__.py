"""Sources and sinks: raw scans, seeds, test-data derivations, versioned tables."""
