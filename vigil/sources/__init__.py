"""Sources and sinks: fixture views, CSV ingest, JSON codec, validation, append sinks."""
