"""Training-data operators: language mixtures, sanitising, decontamination, packed token
files, covering SimHash, quality scoring, URL rules, exact dedup, chat formatting, BPE,
hard-negative mining, WARC archives, Merkle manifests.

Nothing else in the library imports this subpackage.
"""
