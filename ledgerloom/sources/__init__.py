"""Sources: the driver's star tables, the raw retail shapes derived from them, seeds, sinks."""
