"""Area classifications attached to records by location key and date, as Spark DataFrame jobs."""

from .registry import REGISTRY, Edition, Registry, RuralityVersion  # noqa: F401
