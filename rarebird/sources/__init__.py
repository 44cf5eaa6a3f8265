"""Sources and sinks: SQL / file sources, table sinks, model save and load."""
