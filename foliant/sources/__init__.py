"""Readers and writers: archives, pages, extracted text, results, annotations, external converters."""
