"""Training-data operators: token files, near-dedup, mixing, line dedup,
quality, packing, embeddings, toxicity, language id and top-k search.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds the
queries of ``llm.queries`` when the folder is present.
"""
