"""Conversation tables to training samples, as Spark DataFrame operators."""

from .options import PrepOptions

__all__ = ["PrepOptions"]
