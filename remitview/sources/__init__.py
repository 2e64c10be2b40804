"""Input roles, test-data stand-ins and extract sinks."""
