"""tunelake: the data side of instruction tuning as DataFrame-to-DataFrame functions on Spark."""

__version__ = "0.1.0"
