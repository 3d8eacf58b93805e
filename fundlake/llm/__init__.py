"""Operators for large training-data pipelines: language-model scoring, mixing,
nearest neighbours, near-duplicate removal, classifiers, decontamination,
language identification, page extraction and token storage.

Nothing outside this subpackage imports it.
"""
