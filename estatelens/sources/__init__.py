"""Sources and sinks: catalog roles, fleet scans, inventory/report writers."""
