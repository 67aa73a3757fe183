"""Tables and reports that are written: keyed tables with versions, issues, logs, snapshots, reports."""
