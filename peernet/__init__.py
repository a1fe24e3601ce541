"""Peer-network analytics on Spark: feed messages and block data in, session and propagation facts out."""

from peernet.config import RunConfig

__all__ = ["RunConfig"]
