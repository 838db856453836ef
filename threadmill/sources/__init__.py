"""Sources and sinks: landed JSON, tables, alias and price dimensions, test-table adapters."""
