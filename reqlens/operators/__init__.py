"""DataFrame -> DataFrame operators: quality profile, cleaning, features, gates, summaries."""

from reqlens.operators import clean, features, gates, quality, summaries

__all__ = ["clean", "features", "gates", "quality", "summaries"]
