"""Operators over tables of documents, pages, blocks, words and table cells."""
