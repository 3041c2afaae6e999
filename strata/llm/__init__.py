"""Operators for preparing training data: decontamination, PII, quality, packing, WARC, HTML, tokens, secrets, dedup."""
