"""Operators for training data: packing, token files, decontamination, filters, near duplicates."""
