"""Checks on model responses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill.functions.text import strip

# Default length limits and the phrases that close a conversation.
MIN_ANSWER = 10
MAX_ANSWER = 4000
CLOSING_PHRASES = ["that's all", "no more", "finished", "完成", "结束"]
SHORT_ANSWER = 20
SHORT_FROM_TURN = 3


def within_limits(response: Column, low: int = MIN_ANSWER, high: int = MAX_ANSWER) -> Column:
    """Trimmed length at least ``low`` and raw length at most ``high``."""
    text = F.coalesce(response, F.lit(""))
    return (F.length(strip(text)) >= low) & (F.length(text) <= high)


def valid_response(response: Column, low: int = MIN_ANSWER, high: int = MAX_ANSWER) -> Column:
    """A response worth keeping as a turn; an empty one never is."""
    return (F.coalesce(response, F.lit("")) != "") & within_limits(response, low, high)


def closes(response: Column, turn_no: Column) -> Column:
    """True when the conversation stops after this turn (its number counts kept turns)."""
    lowered = F.lower(response)
    said = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(p)) for p in CLOSING_PHRASES])
    trailing_off = (turn_no >= SHORT_FROM_TURN) & (F.length(strip(response)) < SHORT_ANSWER)
    return said | trailing_off
