"""Corpus preparation operators: sharding, scoring, tokenising, packing, fingerprints, dedup, scans, media, mixing.

Nothing else in the library imports this package; ``queries()`` lists its registered queries.
"""
