"""Runs that read, transform and write whole layers, and the registered queries."""
