"""Job-posting analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames to a DataFrame.  The modules:

* ``schemas``    table schemas and keys
* ``functions``  column expressions: text, salary, location, dates
* ``operators``  table operators: dictionary match, ids, upsert, lookup, checks
* ``sources``    CSV readers and versioned Parquet tables
* ``plans``      the analytics marts, the reports on them, the refresh jobs
"""
