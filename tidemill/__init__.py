"""Machine-learning data operations as Spark DataFrame operators.

``operators`` holds the batch operators (DataFrame in, DataFrame out), ``streaming`` their Structured
Streaming forms, ``sources`` the readers and sinks, ``functions`` the shared column and aggregation helpers,
and ``plans`` the registered queries with their SQL oracles.
"""
