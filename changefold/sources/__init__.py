"""Sources and sinks: the driver's test tables, message logs, table storage."""
