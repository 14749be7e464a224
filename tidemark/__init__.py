"""tidemark: event logs and wide attribute tables into features, clusters and
predictions, written as plain Spark DataFrame jobs.

Layout
------
sources/    readers, writers and the stand-in mappings over the test tables
functions/  column expressions (scalar rules, tokenising)
operators/  DataFrame -> DataFrame operators (cleaning, profiling, state joins,
            encoding, text, sampling, metrics, models)
plans/      composed end-to-end jobs and the query registry
streaming/  Structured Streaming forms of the batch operators
"""

__version__ = "0.1.0"
