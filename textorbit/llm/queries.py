"""All queries of this package and their SQL."""

from textorbit.llm import bands, decontaminate, hostpaths, langid, lloyd, mixer, mixing, omh, rff, sharding, trie, urlrules, warc

_MODULES = (mixer, warc, rff, omh, mixing, urlrules, bands, sharding, decontaminate, hostpaths, langid, trie, lloyd)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
