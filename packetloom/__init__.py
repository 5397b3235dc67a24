"""Network-flow telemetry on Spark: captured export packets in, normalised flows and reports out."""
