"""Road-incident analytics on Spark: ingest, cleaning, profiling, features,
tree models and metrics as DataFrame-to-DataFrame steps."""

__version__ = "0.1.0"
