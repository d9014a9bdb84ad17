"""Training-data operators (one module each) and the corpus pipeline's stages.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its queries
(``clickflow.llm.queries``) only where the package can be imported.
"""
