"""All registered queries of the library's own operators."""

from __future__ import annotations

from strataflow.plans import catalogue, fields, pages, popular, sheets, timeline, upkeep

QUERIES = {**timeline.QUERIES, **catalogue.QUERIES, **popular.QUERIES, **pages.QUERIES, **fields.QUERIES, **sheets.QUERIES, **upkeep.QUERIES}
ORACLE = {**timeline.ORACLE, **catalogue.ORACLE, **popular.ORACLE, **pages.ORACLE, **fields.ORACLE, **sheets.ORACLE, **upkeep.ORACLE}
FLAGSHIP = "timeline_segments"
