"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from lexispan.plans import chains, files, news, qa, reviews

AREAS = (news, reviews, qa, chains, files)

QUERIES = {name: query for area in AREAS for name, query in area.QUERIES.items()}
ORACLES = {name: text for area in AREAS for name, text in area.ORACLES.items()}
