"""Change-feed analytics on Spark: validate, count and pattern-match a stream of page edits."""

from changefeed.settings import Settings

__all__ = ["Settings"]
