"""Sources, sinks and stored state."""
