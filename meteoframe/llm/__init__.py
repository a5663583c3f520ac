"""Training-data operators: scoring, search, fingerprints, filters, fixity,
tokenisation, de-duplication, mixing and token files.

Nothing else in the library imports this subpackage. General helpers (the
shared scratch folder, table loading) come from the library.
"""
