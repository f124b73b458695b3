"""Incremental execution of the row-level stages.

The analysed data is a batch snapshot, so the analyses themselves are batch.
What can run incrementally is the per-row part of the pipeline (clean and
derive features): see :mod:`reqlens.streaming.incremental`.
"""
