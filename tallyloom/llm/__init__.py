"""Operators for preparing training corpora. Nothing outside this folder and its tests imports it."""
