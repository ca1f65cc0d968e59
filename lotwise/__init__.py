"""Marketplace listing analytics as Spark jobs: profiling, cleaning, features, models, scoring."""

__version__ = "0.1.0"
