"""Code-to-label lookups and ordered classifications."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# The labels every downstream report relies on.
POSITIONS = {1: "Goalkeeper", 2: "Defender", 3: "Midfielder", 4: "Forward"}
DIFFICULTIES = {1: "Very Easy", 2: "Easy", 3: "Medium", 4: "Hard", 5: "Very Hard"}
HOME, AWAY = "Home", "Away"
STRONG_BUY, BUY, STRONG_SELL, SELL, NEUTRAL = "Strong Buy", "Buy", "Strong Sell", "Sell", "Neutral"


def label(code: Column, labels: dict[int, str]) -> Column:
    """Label of ``code``; NULL for a NULL or unlisted code."""
    (first, text), *rest = labels.items()
    return reduce(
        lambda chain, item: chain.when(code == item[0], item[1]), rest, F.when(code == first, text)
    )


def position(code: Column) -> Column:
    return label(code, POSITIONS)


def difficulty(code: Column) -> Column:
    return label(code, DIFFICULTIES)


def transfer_momentum(bought: Column, sold: Column) -> Column:
    """Five classes, first match wins. A NULL on either side is ``Neutral``."""
    def lean(more, less, strong, mild):
        return F.when(more > less * 2, strong).when(more > less, mild)

    return F.coalesce(
        lean(bought, sold, STRONG_BUY, BUY), lean(sold, bought, STRONG_SELL, SELL), F.lit(NEUTRAL)
    )
