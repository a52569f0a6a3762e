"""Operators for preparing training text: each module holds one operator and its general interface.

``queries`` registers one query per operator. Nothing outside this folder and ``corpus_pipeline.py`` uses it.
"""
