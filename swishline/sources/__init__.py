"""Reading and writing: plays, the event stream, telemetry and artifacts."""
