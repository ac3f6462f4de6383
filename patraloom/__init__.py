"""patraloom: Spark-first curation, labelling and evaluation of text tables."""

__version__ = "0.1.0"
