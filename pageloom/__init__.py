"""pageloom: web-catalogue table jobs on Spark.

``functions`` holds Column functions, ``operators`` DataFrame jobs,
``sources`` table readers, ``streaming`` the incremental intake and
``plans`` the registered queries with their DuckDB oracles.
"""

__version__ = "0.1.0"
