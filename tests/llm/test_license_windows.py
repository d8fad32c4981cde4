"""op3: wrapped, embedded and slightly changed notices, against brute-force Dice over all windows."""

from __future__ import annotations

import re
import textwrap

from beaconlake.llm import licenses

MIT, BSD = licenses.TEMPLATES["MIT"][-1], licenses.TEMPLATES["BSD-3-Clause"][0]
PLAIN = "some prose that goes before it and says nothing of note"


def brute_best(text):
    """The largest Dice of any window with any wording."""
    def split(t):
        return re.findall(r"[a-z0-9]+", t.lower())

    words, best = split(text), 0.0
    pairs = list(zip(words, words[1:]))
    for w in (w for ws in licenses.TEMPLATES.values() for w in ws):
        own = set(zip(split(w), split(w)[1:]))
        high = licenses.bounds(len(own), licenses.MIN_DICE)[1]
        for i in range(len(pairs)):
            found = set()
            for pair in pairs[i:i + high]:
                found.add(pair)
                best = max(best, 2 * len(found & own) / (len(found) + len(own)))
    return best


def test_windows_across_lines(spark):
    cases = [
        (MIT, ["MIT"]), (textwrap.fill(MIT, 80), ["MIT"]), (textwrap.fill(BSD, 60), ["BSD-3-Clause"]),
        (f"{PLAIN}\n{textwrap.fill(MIT.replace('hereby', 'now'), 40)}\n{PLAIN}", ["MIT"]),
        ("Copyright 2024 Example Inc. All rights reserved.", ["All-rights-reserved"]),
        ("This small tool is released under the MIT License.", ["MIT"]),
        (f"{PLAIN} licensed under CC BY-NC 4.0 {PLAIN}. All rights\nreserved, {PLAIN}", ["All-rights-reserved", "CC-BY-NC-4.0"]),
        (PLAIN, []), ("rights reserved", []), (None, []),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)] + [(99, cases[3][0])], "i int, text string")
    found = {r.i: r.matches for r in licenses.scan_licenses(docs).collect()}
    for i, (text, names) in enumerate(cases):
        assert [m.license for m in found[i]] == names, text
        best = brute_best(text or "")
        if best >= licenses.MIN_DICE:
            assert abs(max(m.dice for m in found[i]) - best) < 1e-9
        else:
            assert not found[i]
    assert found[3] == found[99] and found[3][0].line == 2


def test_a_notice_beside_a_better_one_is_found(spark):
    """Two notices that share words: the one with the smaller coefficient counts without the shared words."""
    templates = {"A": ["one two three four five six seven eight nine ten shared words"], "B": ["shared words begin another notice that is longer than the one before it by far"]}
    text = "one two three four five six seven eight nine ten shared words begin another notice that is longer than the one before it by far"
    docs = spark.createDataFrame([(text,), (f"{text} and {text}",)], "text string")
    first, twice = (r.matches for r in licenses.scan_licenses(docs, templates).collect())
    assert [(m.license, round(m.dice, 3)) for m in sorted(first, key=lambda m: m.license)] == [("A", 0.9), ("B", 1.0)]
    assert sorted(m.license for m in twice) == ["A", "A", "B", "B"]


def test_all_matches_against_brute_force(spark):
    """Names of all matches: the best window first, then the best that does not overlap one that is taken."""
    import random

    random_ = random.Random(6)
    words = [f"w{i}" for i in range(12)]
    templates = {name: [" ".join(random_.choices(words, k=random_.randint(5, 9)))] for name in "ABCD"}
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(random_.randint(1, 4)):
            piece = templates[random_.choice("ABCD")][0].split()
            if random_.random() < 0.5:
                piece[random_.randrange(len(piece))] = "other"
            parts += piece + random_.choices(words + ["x", "y"], k=random_.randint(0, 4))
        texts.append(" ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    found = {r.i: sorted((m.license, round(m.dice, 9)) for m in r.matches) for r in licenses.scan_licenses(docs, templates).collect()}
    for i, text in enumerate(texts):
        words_, windows = text.split(), []
        for name, (wording,) in templates.items():
            own = set(zip(wording.split(), wording.split()[1:]))
            for a in range(len(words_)):
                for b in range(a + 1, len(words_)):
                    pairs = list(zip(words_[a:b + 1], words_[a + 1:b + 1]))
                    if pairs[0] in own and pairs[-1] in own:
                        dice = 2 * len(set(pairs) & own) / (len(set(pairs)) + len(own))
                        if dice >= licenses.MIN_DICE:
                            windows.append((-dice, a - b, a, name, b))
        taken = []
        for w in sorted(windows):
            if not any(w[2] <= t[4] and t[2] <= w[4] for t in taken):
                taken.append(w)
        assert found[i] == sorted((t[3], round(-t[0], 9)) for t in taken), text
