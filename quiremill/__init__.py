"""Document-corpus analytics on Spark: pages, blocks, words and books as DataFrames."""

__version__ = "0.1.0"
