"""starloom: star-schema, history, change-feed and data-comparison operators on PySpark."""

__version__ = "0.1.0"
