"""Sources and sinks: CSV ingest, alias JSON, fixed dimension tables, the driver-table view, CSV/JSON sinks."""
