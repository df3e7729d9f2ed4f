"""Part of the corpus engine; see the package docstring."""
