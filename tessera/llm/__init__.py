"""Training-data operators: deduplication, language, extraction, joins, search, packing, tokens, rules.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

from tessera.llm.queries import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
