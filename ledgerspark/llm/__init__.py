"""Training-data operators: ten corpus-preparation jobs written as Spark DataFrame programs.

Each module holds one operator with a general interface (any DataFrame, named id and
text columns); ``queries`` holds the thin registered queries over the standard tables.
"""
