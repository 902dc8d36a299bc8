"""Operators for training-data pipelines: fingerprints, packing, WARC derivatives, exact and near
duplicates, token files, quality ledgers, sharding, piece encoding and a class-factored model.

Nothing outside this subpackage imports it; ``queries`` holds the registered queries."""
