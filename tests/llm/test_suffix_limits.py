"""op2: documents that only the verdict by suffix array rejects, and ones that it keeps."""

from __future__ import annotations

import pytest

from beaconlake.llm import suffix_rules


def text(n_words, repeats):
    """``n_words`` words, all different but for passages of the given lengths that stand there twice."""
    passages = [[f"p{k}w{i}" for i in range(length)] for k, length in enumerate(repeats)]
    other = [f"o{i}" for i in range(n_words - 2 * sum(repeats))]
    out = []
    for k, passage in enumerate(passages + passages):
        out += passage + other[10 * k:10 * k + 10]
    return " ".join(out + other[20 * len(passages):])


@pytest.mark.parametrize("n_words, repeats, kept", [
    (1000, [90], False), (2000, [45], False), (1000, [12] * 6, False),
    (1000, [40], True), (400, [10], True), (1000, [12] * 4, True),
])
def test_limits_bind_beyond_the_base_rule(n_words, repeats, kept):
    found = suffix_rules.judge([text(n_words, repeats)])
    assert found["n_words"][0] == n_words and found["longest_repeat"][0] == max(repeats)
    assert found["n_covered_words"][0] == found["n_repeat_words"][0] == 2 * sum(repeats)
    assert not found["base_failed"][0]
    assert found["kept"][0] == kept
