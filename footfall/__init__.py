"""footfall: product-event analytics as Spark jobs."""

from footfall.session import configure

__all__ = ["configure"]
