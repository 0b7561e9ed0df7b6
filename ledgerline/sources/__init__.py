"""Sources: table scans, the ops fixture, CSV, run records, generator, JDBC."""
