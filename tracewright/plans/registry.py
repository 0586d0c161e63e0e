"""All queries of the library by name: (spark, sf_dir) → DataFrame."""

from . import analytics, normalisation  # noqa: F401  (adds its queries)

QUERIES = {**analytics.QUERIES}
