"""Queries of the core operators on the driver's tables, each with the same result in SQL where SQL can express it.

Every query runs over its whole tables. A limit stands only where it is the feature: a page, a top list, a sample.
"""

from __future__ import annotations

from litscout.plans import records, reports, scholarly, texts

FLAGSHIP = "search_terms_facets"
QUERIES = scholarly.QUERIES | texts.QUERIES | records.QUERIES | reports.QUERIES
ORACLES = scholarly.ORACLES | texts.ORACLES | records.ORACLES | reports.ORACLES
