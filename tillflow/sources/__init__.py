"""Sources, sinks and catalog tables."""
