"""Spans of long texts: linear time, and the same spans as a look at every pair."""

import random
import time
import unicodedata


def lexicon():
    return [("vile", 2.0), ("=pond", 1.5), ("scum", 3.0), ("vil", 1.0)]


def test_shields_equal_a_look_at_every_pair():
    from curatrix.llm.toxicity import Matcher, fold

    rng = random.Random(1)
    exceptions = ("vile pond", "pond scum", "scum vile pond")
    for _ in range(300):
        text = " ".join(rng.choice(("vile", "pond", "scum", "ponds", "fine", "viler")) for _ in range(rng.randint(0, 30)))
        low = fold(text)
        letter = lambda i: 0 <= i < len(text) and unicodedata.category(text[i])[0] == "L"  # noqa: B023, E731
        shields = [(i, i + len(p)) for p in exceptions for i in range(len(low)) if low.startswith(p, i) and not letter(i - 1) and not letter(i + len(p))]
        want = {}
        for term, weight in lexicon():
            key = term.removeprefix("=")
            for i in range(len(low)):
                if low.startswith(key, i) and not letter(i - 1) and not (term[0] == "=" and letter(i + len(key))) and weight > want.get(i, (0, -1))[1]:
                    want[i] = (i + len(key), weight)
        want = [(s, e, w) for s, (e, w) in sorted(want.items()) if not any(a <= s and e <= b for a, b in shields)]
        assert Matcher(lexicon(), exceptions).matches(text) == want


def test_toxicity_of_a_megabyte():
    from curatrix.llm.toxicity import Matcher, _phrases

    text = "vile pond scum " * 70_000
    began = time.perf_counter()
    found = Matcher(lexicon(), ("vile pond", "nice scum")).matches(text)
    assert len(found) == 70_000 and _phrases(text, found) == ["scum", "scum vile"]
    assert time.perf_counter() - began < 20


def test_exception_phrases_are_two_whole_words():
    from curatrix.llm.toxicity import Matcher, _phrases

    text = "a vile " + "x" * 60 + " pond"
    assert _phrases(text, Matcher(lexicon()).matches(text)) == ["pond", "vile " + "x" * 60]


def test_personal_data_of_a_megabyte():
    from curatrix.llm.pii import base_spans, candidates

    text = "call +1 (555) 010-9988 or 555-0199-22 ab12cd34ef56ab12cd34ef56ab12cd34 me@here.org " * 12_000
    began = time.perf_counter()
    base = base_spans(text)
    more = candidates(text, base)
    assert time.perf_counter() - began < 60
    assert len(base) >= 24_000 and len(more) >= 12_000


def test_candidates_overlap_no_base_span():
    from curatrix.llm.pii import _SHAPES, base_spans, candidates

    rng = random.Random(3)
    bits = ("+1 (555) 010-9988", "555-0199-22", "ab12cd34ef56ab12cd34ef56", "me@here.org", "10.2.3.4", "12 Long Street", "4111 1111 1111 1111", "word")
    for _ in range(200):
        text = rng.choice(("", " ", ",")).join(rng.choice(bits) + rng.choice(("", " ")) for _ in range(rng.randint(0, 15)))
        base = base_spans(text)
        want = sorted((m.start(), m.end(), kind) for kind, pattern in _SHAPES for m in pattern.finditer(text) if not any(m.start() < b and a < m.end() for a, b, _ in base))
        has_digit = any(c in "0123456789" for c in text)
        assert sorted(c[:3] for c in candidates(text, base)) == (want if has_digit else [])
