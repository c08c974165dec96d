"""Operators over the catalogue, the manifest, pages and recognized text: DataFrame in, DataFrame out."""
