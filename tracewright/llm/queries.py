"""The queries of this subpackage and their SQL, for registration."""

from . import bpe, exact, html, langid, licenses, minhash, packing, pii, quality, warc

MODULES = (bpe, html, exact, warc, pii, licenses, quality, langid, minhash, packing)
QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
