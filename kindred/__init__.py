"""Kindred: profile similarity, record linkage and talent analytics on PySpark.

Every operator takes DataFrames and returns a DataFrame; nothing holds data in
Python objects.  See README.md for the layout and the scale notes.
"""
