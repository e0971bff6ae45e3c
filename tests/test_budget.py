"""Chats fitted to a budget, held against trying every cut."""

from hypothesis import given, settings
from hypothesis import strategies as st

from curatrix.operators.budget import MARK, estimate, fit, middle, tail

TEXTS = st.text("ab \n漢é", max_size=60)


@given(TEXTS, st.integers(-2, 30))
@settings(max_examples=150, deadline=None)
def test_tail_is_the_longest(text, limit):
    fits = [n for n in range(len(text) + 1) if estimate(text[len(text) - n :]) <= limit]
    assert tail(text, limit) == (text[len(text) - max(fits) :] if fits else "")


@given(TEXTS, st.integers(-2, 30))
@settings(max_examples=150, deadline=None)
def test_middle_fits(text, limit):
    out = middle(text, limit)
    assert estimate(out) <= max(limit, 0)
    assert (out == text) == (estimate(text) <= max(limit, 0)) or not text or MARK in out


@given(TEXTS, st.lists(TEXTS, min_size=1, max_size=7), st.integers(1, 120))
@settings(max_examples=150, deadline=None)
def test_fit_keeps_first_and_last(system, texts, limit):
    texts = texts[: len(texts) - 1 + len(texts) % 2]
    messages = [(("user", "assistant")[i % 2], x) for i, x in enumerate(texts)]
    got, kept, error = fit(system, messages, limit)
    total = estimate(got) + 4 + sum(estimate(c) + 4 for _, c in kept)
    assert error is None and kept[-1][0] == "user" and len(kept) % 2 == 1 and system.endswith(got)
    assert len(kept) == 1 or kept[0] == messages[0]
    assert total <= limit or got == "" and kept[-1][1] == "" and len(kept) <= 3


def test_turns_and_no_limit():
    assert fit("s", [("user", "a"), ("user", "b")], 9)[2] and fit("s", [], 9)[2]
    assert fit("s" * 99, [("user", "a" * 99)], 0) == ("s" * 99, [("user", "a" * 99)], None)
