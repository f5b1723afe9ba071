"""Operators for preparing training text: deduplication, classifiers, decontamination, mixing, token files."""
