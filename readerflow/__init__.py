"""readerflow: book-to-dialogue tables and practice analytics on Spark.

Subpackages: ``functions`` (Column functions), ``operators`` (DataFrame
operators), ``sources`` (scans, sinks, fixture views), ``plans`` (registered
queries and their SQL oracles), ``streaming`` (Structured Streaming jobs);
``api`` maps the original app's functions to table-level calls.
"""

__version__ = "0.1.0"
