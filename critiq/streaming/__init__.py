"""Streaming intake: analyse each newly arrived feedback file (see ``intake``)."""
from .intake import feedback_schema, start_intake

__all__ = ["feedback_schema", "start_intake"]
