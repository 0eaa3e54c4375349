"""Semi-structured normalisation on Spark: flatten, clean, unpivot, extract, key, check, load.

Sub-packages
------------
``functions``  column expressions (text, numbers, JSON documents)
``operators``  DataFrame-in / DataFrame-out building blocks
``sources``    readers
``sinks``      writers
``plans``      composed raw -> cleaned -> curated jobs
``catalog``    the queries checked against SQL
"""
