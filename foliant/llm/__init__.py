"""Training-data operators.  Nothing outside this subpackage imports it.

Conventions shared by all ten operators:

* a null text counts as the empty text unless a docstring says otherwise;
* only the named id, text and url columns are read, so extra columns, clashing
  names included, never matter;
* an empty table gives an empty result with the same columns;
* rows that repeat another row in full are rows of their own.
"""
