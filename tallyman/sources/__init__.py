"""Sources, specs and sinks."""
