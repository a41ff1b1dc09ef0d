"""Sample preparation over append-only streams of conversations."""

from .lengths import length_stream
from .samples import checkpoint_location, prepare_stream
from .turns import conversations_of_turns, prepare_turn_stream

__all__ = ["checkpoint_location", "conversations_of_turns", "length_stream", "prepare_stream", "prepare_turn_stream"]
