"""Training-data operators: thirteen corpus operators, their queries and SQL.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its queries if it can be imported.
Each module holds one operator with a general interface (texts, spans, rows); ``queries`` derives the digest columns
of the registered ``opN_*`` queries from it.
"""
