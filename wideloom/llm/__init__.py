"""Operators for large training-data preparation: PII, exact and near duplicates, URL rules, source
mixing, quality and toxicity scores, WARC archives, packing, document sketches, hard negatives, language-model
scores and periodic runs.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator;
the corpus pipeline at the repository top chains five of them.
"""
