"""Writers: partitioned files, tables with merge, message logs, JDBC, metric samples."""
