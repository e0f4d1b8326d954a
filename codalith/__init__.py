"""Codalith: hierarchical label coding on Spark DataFrames."""
