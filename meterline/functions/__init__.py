"""Column expressions: name shaping, code lookup, trip clocks, keep rules."""
