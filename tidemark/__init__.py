"""Change detection and rule-driven measures for warehouse tables, on Spark."""

__version__ = "0.1.0"
