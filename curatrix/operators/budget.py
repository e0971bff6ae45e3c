"""Chats fitted to an input budget of estimated tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# What stands for text cut out, the tokens that each message adds, the head's share of a cut message.
MARK, OVERHEAD, HEAD = "\n...[truncated]...\n", 4, 0.3
FITTED = "id long, system string, messages array<struct<role string, content string>>, error string"


def _tokens(ascii_chars, others):
    return (ascii_chars + 3) // 4 + others


def _running(text: str) -> tuple[np.ndarray, np.ndarray]:
    """ASCII and other characters among the first 0, 1, ... characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    plain = np.concatenate([[0], np.cumsum(codes < 128)])
    return plain, np.arange(len(plain)) - plain


def estimate(text: str) -> int:
    plain, other = _running(text)
    return int(_tokens(plain[-1], other[-1]))


def tail(text: str, limit: int) -> str:
    """The longest end of the text within the limit: costs of all ends at once."""
    plain, other = _running(text)
    cost = _tokens(plain[-1] - plain[::-1], other[-1] - other[::-1])
    kept = int(np.searchsorted(cost, limit, "right")) - 1 if limit > 0 else 0
    return text[len(text) - kept :]


def middle(text: str, limit: int) -> str:
    """Head and tail about a mark; a limit too small for the mark leaves a tail."""
    if limit <= 0 or estimate(text) <= limit:
        return text if limit > 0 else ""
    if estimate(MARK) > limit:
        return tail(text, limit)
    plain, other = _running(text)
    kept = np.arange(len(text))
    head = np.where(kept >= 2, np.minimum(kept - 1, np.maximum(1, np.round(kept * HEAD).astype(int))), 0)
    start = len(text) - (kept - head)
    cost = _tokens(plain[head] + len(MARK) + plain[-1] - plain[start], other[head] + other[-1] - other[start])
    best = int(np.searchsorted(cost, limit, "right")) - 1
    return text[: head[best]] + MARK + text[start[best] :]


def fit(system: str, messages: list[tuple[str, str]], limit: int) -> tuple[str, list[tuple[str, str]], str | None]:
    """The oldest pairs after the first message go, then the head of the system text, then the middle of the last
    message. A limit of zero or less changes nothing; turns that don't alternate from user to user are an error."""
    roles = [role for role, _ in messages]
    if len(roles) % 2 == 0 or roles != [("user", "assistant")[i % 2] for i in range(len(roles))]:
        return system, messages, "messages must alternate user/assistant and end with user"
    if limit <= 0:
        return system, messages, None
    costs = np.array([estimate(content) + OVERHEAD for _, content in messages])
    ends = np.append(np.cumsum(costs[::-1])[::-1], 0)
    room = limit - OVERHEAD - estimate(system)
    starts = range(1, max(len(messages) - 2, 1) + 1, 2)
    start = next((i for i in starts if costs[0] + ends[i] <= room), starts[-1])
    kept, used = messages[:1] + messages[start:], int(costs[0] + ends[start])
    if used > room:
        system = tail(system, limit - OVERHEAD - used)
        room = limit - OVERHEAD - estimate(system)
    if used > room:
        role, content = kept[-1]
        kept = kept[:-1] + [(role, middle(content, room - (used - estimate(content))))]
    return system, kept, None


def fit_messages(rows: DataFrame) -> DataFrame:
    """(id, system, messages, max_tokens) -> (id, system, messages, error), in Arrow batches: where a text is cut
    depends on the cost of each of its ends. Null texts are empty, no messages are an error; ids may repeat."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, system, messages, limit in batch.itertuples(index=False):
                turns = [(m["role"], m["content"] or "") for m in (messages if messages is not None else [])]
                system, kept, error = fit(system or "", turns, int(limit))
                out.append((key, system, [{"role": r, "content": c} for r, c in kept], error))
            yield pd.DataFrame(out, columns=["id", "system", "messages", "error"])

    return rows.select("id", "system", "messages", "max_tokens").mapInPandas(run, FITTED)
