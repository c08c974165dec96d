"""Corvidex: document-corpus analytics on Spark DataFrames."""
