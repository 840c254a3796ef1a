"""Medallion pipelines as Spark jobs: landed pages -> Bronze -> Silver -> star schema."""

__version__ = "0.1.0"
