"""Batches of items for a scorer: consecutive, within limits on items, tokens and bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Limits of a batch.
FEWEST, MOST, TARGET = 20, 40, 30
TOKENS, HARD_TOKENS = 12_000, 16_000
BYTES, HARD_BYTES = 65_000, 90_000
LONG_TOKENS, RATIO = 320, 0.35


def cut(rows: Iterator[tuple[int, int, bool]], target: int = TARGET) -> list[int]:
    """The batch of each item (tokens, bytes, chatter) of a package in order.

    A batch closes before an item that breaks a hard limit, or, from the target size on, a soft one. A package of at most MOST items is one batch.
    """
    out, batch, n, t, b, long, chat = [], 0, 0, 0, 0, 0, 0
    for tokens, size, is_chat in rows:
        n, t, b, long, chat = n + 1, t + tokens, b + size, long + (tokens >= LONG_TOKENS), chat + is_chat
        hard = n > MOST or t > HARD_TOKENS or b > HARD_BYTES
        soft = n > max(FEWEST, target) and (t >= TOKENS or b >= BYTES or long / n > RATIO or chat / n > RATIO)
        if n > 1 and (hard or soft):
            batch, n, t, b, long, chat = batch + 1, 1, tokens, size, int(tokens >= LONG_TOKENS), int(is_chat)
        out.append(batch)
    if len(out) <= MOST:
        return [0] * len(out)
    # a short last batch takes items from the one before, which keeps the fewest
    last, before = out.count(batch), out.count(batch - 1) if batch else 0
    moved = max(0, min(FEWEST - last, before - FEWEST)) if batch else 0
    out[len(out) - last - moved :] = [batch] * (last + moved)
    return out


def batches(items: DataFrame, target: int = TARGET) -> DataFrame:
    """package, item_id, batch of items (package, item_id, tokens, bytes, chatter) in order of item_id.

    A package is a unit of work for a scorer, so its size is bounded by what makes packages; each is one small group.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("item_id")
        return pd.DataFrame({"package": g.package, "item_id": g.item_id, "batch": cut(zip(g.tokens.tolist(), g.bytes.tolist(), g.chatter.tolist(), strict=True), target)})

    return items.groupBy("package").applyInPandas(run, "package long, item_id long, batch long")
