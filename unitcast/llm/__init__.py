"""Operators for preparing text corpora (language id, fingerprints, dedup,
sharding, chat formatting, WARC, decontamination, tokenizing, binary output).

One module per operator; ``queries`` registers one query per operator.
"""
