"""Training-data operators: tokenizing, fingerprints, duplicates, filters, mixing, sharding.

Nothing else in the library imports this subpackage.  ``registry`` lists the
queries; each operator module keeps its own general interface.
"""
