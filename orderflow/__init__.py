"""orderflow: commerce event streams on Spark -- validation, dead letters, watermarked dedup,
interval-join correlation, order states, keyed history and windowed metrics, as DataFrame
functions that run the same on bounded tables and Structured Streaming."""

__version__ = "0.1.0"
