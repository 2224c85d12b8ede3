"""Loads, exports and the script gate: sequences of operators and sinks that run jobs."""
