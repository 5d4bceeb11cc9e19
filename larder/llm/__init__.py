"""Operators for preparing large text corpora (training data for language models).

Nothing else in the library imports this subpackage; it uses only the general
helpers of ``larder.session``, ``larder.sources`` and ``larder.plans.tables``.
"""
