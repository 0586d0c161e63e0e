"""DuckDB SQL of the queries that SQL can express, by name."""

from . import analytics, normalisation  # noqa: F401  (adds its queries)

ORACLES = {**analytics.ORACLES}
