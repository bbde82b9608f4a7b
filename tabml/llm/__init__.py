"""Operators for preparing training data: deduplication, archives, licences,
packing, tokenizing, language, toxicity and fingerprints.

Nothing outside this package imports it. Every operator takes a DataFrame and
the names of the columns it needs, selects those columns first (further
columns of the input, whatever their names, are ignored) and returns a
DataFrame with the columns its docstring states.
"""
