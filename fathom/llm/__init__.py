"""Operators for preparing training corpora, each independent of the rest of the library."""
