"""Country-year panel analytics on Spark.

``sources``    reads, writes, shared scratch tables and the panels made from the test tables
``functions``  column expressions: coercion, units, names, statistics
``operators``  DataFrame in, lazy DataFrame out
``plans``      the analyses built from them, the registered queries and their SQL twins
"""
