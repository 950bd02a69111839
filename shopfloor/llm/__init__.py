"""Training-data operators: deduplication, quality, mixing, tokens, packing, language, chat, shards.

Each module holds one operator (its general interface) and the thin query that
:mod:`shopfloor.llm.registry` registers for it.  Nothing outside this
subpackage imports it.
"""
