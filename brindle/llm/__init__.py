"""Operations of a training-data pipeline, each usable on any DataFrame.

Nothing outside this subpackage imports it.  ``queries`` holds the registered
queries and their SQL; every other module holds one operator.
"""
