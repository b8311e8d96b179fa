"""Sources: JDBC scans and parametrised SQL texts."""
