"""Operators for preparing training data, and the queries that apply them.

Nothing else in the library imports this subpackage. Conventions shared by
all operators:

* the caller names the id and text columns; every other column is carried
  along untouched or left out, so extra columns never clash with results;
* a null text counts as empty, rows are never dropped because of nulls;
* work inside a task is bounded by one Arrow batch plus documented caches;
* intermediate tables go to the shared folder of ``spark.checkpoint.dir``.
"""
