"""Queries of this package over the given tables, each with an independent SQL check."""

from tickloom.registry.analytics import ENTRIES as _ANALYTICS
from tickloom.registry.ingestion import ENTRIES as _INGESTION
from tickloom.registry.publishing import ENTRIES as _PUBLISHING
from tickloom.registry.spec import Entry

REGISTERED: dict[str, Entry] = {e.name: e for e in (*_INGESTION, *_ANALYTICS, *_PUBLISHING)}
