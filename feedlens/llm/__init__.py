"""Training-data operators: each module is one operator with its own interface.

``feedlens.llm.registered`` holds the queries; nothing outside this folder (and
``corpus_pipeline.py`` at the top) imports it.
"""
