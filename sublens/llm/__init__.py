"""Training-data operators: near-duplicates, extraction, classifiers, mixing, output.

Nothing else in the package imports this subpackage.
"""
