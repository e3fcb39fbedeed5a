"""Training-data operators: mixing, near-duplicates, repeats, quality, tokens, chat, search, licences.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports it.
"""
