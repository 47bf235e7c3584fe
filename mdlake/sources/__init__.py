"""Landing tables, frame routing and the configured symbol universe."""
