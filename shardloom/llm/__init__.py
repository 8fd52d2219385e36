"""Training-data operators: quality rules, near-duplicate joins, encoding, packing, token files,
web-archive audits, classifiers, line dedup, fingerprints and language identification.

Nothing outside this subpackage imports it."""
