"""Text made for people: prompts and shortened values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Label of each entry in the short prompt and the feature it shows.
PROMPT_FEATURES = {
    "active_duration": "activeDuration",
    "play_count": "playCount",
    "consecutive_play_ratio": "consecutivePlayRatio",
    "best_score": "bestScore",
    "worst_score": "worstScore",
    "mean_score": "meanScore",
    "purchase_count": "purchaseCount",
    "max_purchase": "highestPrice",
}
# The sentence around the entries.
PROMPT_BEFORE = (
    "In a mobile racing game (Game {game}), a player has shown the following activity "
    "in their first 5 days of playing: "
)
PROMPT_AFTER = ". Will the player stop playing in the next 10 days?"


def shorten(value: Column, limit: int = 50) -> Column:
    """Text longer than ``limit`` is cut there and marked with three dots."""
    text = value.cast("string")
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def feature_prompt(game: int, entries: Mapping[str, Column | None]) -> Column:
    """A question about one player; an entry without a column or value shows 0."""
    parts = []
    for label, column in entries.items():
        shown = F.lit("0") if column is None else F.coalesce(column.cast("string"), F.lit("0"))
        parts.append(F.concat(F.lit(f"{label}: "), shown))
    return F.concat(
        F.lit(PROMPT_BEFORE.format(game=game)), F.concat_ws(", ", *parts), F.lit(PROMPT_AFTER)
    )
