"""Corpus operators for training data: packing, decontamination, language identification,
near-duplicates, sharding, licence scans, language-model scores, toxicity, token counts and
nearest neighbours.  Each module is one operator with its own general interface;
``queries.py`` holds the thin registered queries."""
