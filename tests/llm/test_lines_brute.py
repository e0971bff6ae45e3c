"""Line dedup against brute force: every line of a leaf with every template, every document with every other."""

import math
import random
import re
from collections import defaultdict

SIMILARITY, LEADING, MIN_DOCS, LONG, MIN_LONG = 0.8, 3, 4, 20, 2


def masked(line):
    return ["<*>" if re.search("[0-9]", t) else t for t in line.split()]


def templates(lines):
    """{masked line: template} of different masked lines, by their leaves, in order."""
    leaves = defaultdict(list)
    for m in sorted({" ".join(x) for x in lines}):
        tokens = m.split(" ")
        leaves[len(tokens), tuple(tokens[:LEADING])].append(tokens)
    out = {}
    for leaf, members in leaves.items():
        known = []
        for tokens in members:
            for k, template in enumerate(known):
                alike = [a == b or "<*>" in (a, b) for a, b in zip(template, tokens, strict=True)]
                exact = any(a == b != "<*>" for a, b in zip(template, tokens, strict=True))
                if sum(alike) >= SIMILARITY * len(tokens) and (exact or all(alike)):
                    known[k] = [a if a == b else "<*>" for a, b in zip(template, tokens, strict=True)]
                    break
            else:
                k = len(known)
                known.append(list(tokens))
            out[" ".join(tokens)] = (leaf, k)
    return out


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def groups_of(texts):
    """{text: least text of those linked to it by a similarity of 0.8 or more}."""
    texts = sorted(texts)
    group, sets = {t: t for t in texts}, [shingles(t) for t in texts]

    def top(t):
        while group[t] != t:
            t = group[t]
        return t

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                group[top(texts[i])] = top(texts[j])
    return {t: top(t) for t in texts}


def deduplicated(texts):
    lines = {t: {" ".join(m) for raw in t.split("\n") if (m := masked(raw))} for t in texts if t}
    of = templates([m.split(" ") for own in lines.values() for m in own])
    solid = lambda m: sum(t != "<*>" for t in m.split(" "))

    def recurring(chosen, group):
        seen, least = defaultdict(set), {}
        for t in lines:
            for m in lines[t] if len(lines[t]) > 1 else ():
                if of[m] in chosen:
                    seen[of[m]].add(group(t))
                    least[of[m]] = min(least.get(of[m], math.inf), solid(m))
        return {k for k, g in seen.items() if len(g) >= (MIN_LONG if least[k] >= LONG else MIN_DOCS)}

    some = recurring(set(of.values()), lambda t: t)
    holders = {t for t in lines if len(lines[t]) > 1 and any(of[m] in some for m in lines[t])}
    group = groups_of(holders)
    gone = recurring(some, group.get)
    return ["\n".join(raw for raw in t.split("\n") if not (m := masked(raw)) or of[" ".join(m)] not in gone) if t else t for t in texts]


def made(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(("ka", "lo", "mi", "tu", "re", "so", "na", "pe"))
    heads = [[word() for _ in range(rng.choice((4, 6, 8, 22, 26)))] for _ in range(10)]

    def line():
        if rng.random() < 0.5:  # a known line with some of its tail changed, or numbers in it
            own = list(rng.choice(heads))
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                own[rng.randrange(len(own))] = rng.choice((word(), str(rng.randrange(99)), f"x{rng.randrange(9)}"))
            return " ".join(own)
        return " ".join(f"{word()}{word()}{word()}{rng.choice('abcdefgh')}" for _ in range(rng.randint(1, 14)))

    texts = ["\n".join(rng.choice((line(), line(), line(), "", "  ")) for _ in range(rng.randint(1, 7))) for _ in range(90)]
    for t in rng.sample(texts, 12):  # near copies
        texts += [t.replace("ka", "kaa", 1), f"{t}\n{line()}"]
    return texts + texts[:9] + [None, "", " \n ", "one line alone 1"] + ["\n".join(f"{i} " + " ".join(heads[0]) for i in range(4))] * 3 + [" ".join(heads[3]) * 400 + "\nshort"]


def test_line_dedup_equals_brute_force(spark):
    from curatrix.llm.lines import dedup_lines

    for seed in (1, 2, 3):
        texts = made(seed)
        rows = [(i, t, 7, "b", "c") for i, t in enumerate(texts)]
        got = {r["doc_id"]: r for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, row int, line string, template string")).collect()}
        want = deduplicated(texts)
        assert [got[i]["text"] for i in range(len(texts))] == want
        assert all((got[i]["row"], got[i]["line"], got[i]["template"]) == (7, "b", "c") for i in got)
        assert any(a != b for a, b in zip(want, texts, strict=True)) and any(a == b and a for a, b in zip(want, texts, strict=True))
