"""Sources: batch scans, CSV/JDBC dimensions, stream sources."""
