"""Change-data operators for Spark: keyed reduction, merges, schema mapping, shaping and sinks."""
