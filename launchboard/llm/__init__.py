"""Training-data operators: each module is one operator with a DataFrame interface.

Modules that share code use ``words`` (vectorised word splitting and hashing),
``store`` (scratch tables in the shared checkpoint folder) and ``components``
(connected components). ``queries`` holds the registered contract queries.
"""
