"""Training-data operators (tokens, language model, dedup, sharding, PII,
decontamination, quality, WARC, byte-level BPE, fill-in-middle, Merkle manifest,
SentencePiece). Nothing outside this package
imports it; ``queries.py`` registers the ``op1_`` … ``op13_`` queries."""
