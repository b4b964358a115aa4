"""All registered queries (name -> builder) and their oracle SQL."""

from __future__ import annotations

from strata.plans import registry
from strata.plans import (cat_aggs, cat_daily, cat_spatial, cat_temporal, cat_text,  # noqa: F401
                          cat_generate, cat_models, cat_pixels, cat_sources, cat_vectors,
                          cat_verbs)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
