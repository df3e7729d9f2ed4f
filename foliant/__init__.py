"""foliant: a Spark-native engine for document corpora.

``sources`` read and write, ``functions`` are scalar column expressions,
``operators`` are relational operators over line, page, box and score tables,
``plans`` compose them into registered queries, ``streaming`` holds the
structured-streaming forms.  Corpus operators for training data live in the
separate subpackage ``llm``, which nothing else here imports.
"""
