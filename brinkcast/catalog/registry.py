"""All registered queries."""

from __future__ import annotations

from brinkcast.catalog import core, extras, learned, scoring, storing, streams  # noqa: F401
from brinkcast.catalog.core import CASES  # noqa: F401
