"""Training-data operators: sharding, archives, token files, quality rules,
piece encoding, source mixing, nearest neighbours, licence scans,
near-duplicates, exact top-k search, ranked lexical search, main text of
pages and Merkle manifests.  Nothing outside this package imports it."""
