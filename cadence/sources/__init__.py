"""Sources and sinks: landed JSON payloads, stored tables, test adapters."""
