"""The radix tree by itself, and the trie of conversations against plain prefixes, in one task and in many."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from beaconlake.llm import radix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Nodes from all prefixes of all rebuilt conversations."""
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            convs[conv_id].append(((turn is not None, turn or 0), name, (role, text)))
    convs = {c: [t[2] for t in sorted(turns)] for c, turns in convs.items()}
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(convs.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, of in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(of) - 1) * (len(path[-1][1].encode()) if path else 0)
    return sorted((
        (min(of), len(path), min(members[path[:-1]]) if path else None, len(of), children[path], leaves[path], saved[path],
         hashlib.sha256(",".join(str(c) for c in sorted(of) if len(rebuilt[c]) == len(path)).encode()).hexdigest())
        for path, of in members.items()
    ), key=str)


def nodes(spark, rows, parts=3):
    conversations = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = radix_trie.prefix_trie(radix_trie.rebuilt(conversations)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
    return sorted(map(tuple, found.collect()), key=str)


def made_up(seed, n, hot):
    """Conversations over few texts; ``hot`` of them are equal, and a third share the first turn."""
    random_ = random.Random(seed)
    rows = []
    for c in range(-20, n):
        if c % 7 == 3:
            continue
        for turn in range(random_.randint(1, 12)):
            text = "same" if turn == 0 and c % 3 == 0 else random_.choice(["a", "b", "é", "", None])
            rows.append((c, turn if turn != 4 else None, random_.choice(["user", None]), text))
    rows += [(10_000 + 5 * c, turn, "user", f"copy{turn}") for c in range(hot) for turn in range(4)]
    return rows


@pytest.mark.parametrize("turns", [1_000_000, 400, 25])
def test_against_all_prefixes(spark, monkeypatch, turns):
    monkeypatch.setattr(radix_trie, "TASK_TURNS", turns)
    monkeypatch.setattr(radix_trie, "PIECE", 30)
    rows = made_up(1, 150, 120)
    assert nodes(spark, rows) == plain(rows)


def test_one_conversation_and_none(spark):
    assert nodes(spark, []) == []
    rows = [(3, 0, "user", "x")]
    assert nodes(spark, rows) == plain(rows)
    # Every turn of conversation 3 is replaced by those of the absent conversation 0.
    assert [n[:4] for n in nodes(spark, rows)] == [(3, 0, None, 1)]


def test_long_conversations(spark):
    rows = [(5, turn, "user", str(turn % 10)) for turn in range(120)] + [(10, turn, "user", str(turn % 10)) for turn in range(110)]
    assert nodes(spark, rows) == plain(rows)
    # One of very many turns: a node per turn and the root, each with one conversation.
    rows = [(5, turn, "user", str(turn % 10)) for turn in range(20_000)]
    found = nodes(spark, rows)
    assert sorted(n[1] for n in found) == list(range(20_001)) and {n[3] for n in found} == {1} and {n[5] for n in found} == {1}


def test_tree_layouts_grow():
    root = radix_trie.Node(b"")
    layouts = []
    keys = [bytes([b]) + b"tail" for b in random.Random(3).sample(range(256), 256)]
    for key in keys:
        radix_trie.insert(root, key).ends = key
        layouts.append(root.layout)
    assert [layouts.index(n) for n in (4, 16, 48, 256)] == [0, 4, 16, 48]
    assert [child.ends for child in root.below()] == sorted(keys)
    assert [root.child(key[0]).ends for key in keys] == keys


def test_tree_paths_are_compressed_and_split():
    root = radix_trie.Node(b"")
    random_ = random.Random(4)
    keys = {bytes(random_.choices(b"ab", k=random_.randint(0, 12))) for _ in range(400)}
    for key in keys:
        radix_trie.insert(root, key).ends = key
    for key in keys:
        assert radix_trie.insert(root, key).ends == key
    stack, found, inner = [root], [], []
    while stack:
        node = stack.pop()
        if node.ends is not None:
            found.append(node.ends)
        elif node is not root:
            inner.append(len(node.children))
        stack += node.below()
    assert sorted(found) == sorted(keys) and min(inner, default=2) >= 2


def test_shared_length():
    for a, b, same in ((b"", b"", 0), (b"a", b"", 0), (b"ab", b"ab", 2), (b"abc", b"abd", 2), (b"x", b"y", 0), (b"abcd", b"ab", 2)):
        assert radix_trie.shared_length(a, b) == same
