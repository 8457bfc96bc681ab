"""Sources and sinks: driver tables, request files, dimensions, table writers."""
