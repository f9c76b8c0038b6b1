"""The trie against a dictionary of prefixes, for all ways to split the peeling."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, size string, h string"


def brute(rows):
    """The nodes of (conv_id, turn, role, text) rows with different turns in a conversation, null first."""
    said = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            said[conv].append((role or "", text or ""))
    rebuilt = {}
    for conv, own in said.items():
        h = zlib.crc32(str(conv).encode()) % 4
        rebuilt[conv] = tuple(said.get(conv - int(math.fmod(conv, 20)), [])[:h] + own[h:])
    nodes = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(conv)
    children = defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(members) - 1) * words
    out = []
    for path, members in nodes.items():
        ended = ",".join(str(c) for c in sorted(members) if rebuilt[c] == path)
        parent = min(nodes[path[:-1]]) if path else None
        row = (min(members), len(path), parent, len(members), children[path], leaves[path], saved[path])
        out.append((*row, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=repr)


def made_rows(seed, count=160):
    pick, rows = random.Random(seed), []
    for conv in range(count):
        if conv % 20 == 0 and pick.random() < 0.4:
            continue
        kind = pick.random()
        turns, name = (1, "hot") if kind < 0.3 else (pick.randrange(1, 30), "snapshot") if kind < 0.6 else (pick.randrange(1, 6), str(pick.randrange(4)))
        for i in range(turns):
            role = "u" if name == "snapshot" else pick.choice(["user", None])
            rows.append((conv, None if i == 0 and pick.random() < 0.1 else i, role, None if pick.random() < 0.02 else f"{name} turn {i}\x0b"))
    pick.shuffle(rows)
    return rows


def found(spark, rows, group_rows=pt.GROUP_ROWS):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return sorted(map(tuple, pt.prefix_trie(df, group_rows).collect()), key=repr)


@pytest.mark.parametrize("group_rows", [pt.GROUP_ROWS, 80, 1])
def test_trie_matches_brute_force(spark, group_rows):
    rows = made_rows(group_rows)
    assert found(spark, rows, group_rows) == brute(rows)


def test_long_conversations_are_cut_into_slices(spark, tiny_slices):
    rows = made_rows(9, 60) + [(c, i, "u", f"long {i if i < 150 else (c, i)}") for c in (1, 41) for i in range(200)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    assert found(spark, rows, 40) == brute(rows)


def test_many_copies_and_parts_of_ids(spark, monkeypatch):
    monkeypatch.setattr(pt, "IDS_AT_ONCE", 3)
    rows = [(c, i, "u", f"t{i}") for c in range(5, 300, 2) for i in range(4)]
    assert found(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    # Negative ids, roles and texts that join to the same string, no turns left, a family whose first member is missing.
    rows = [(-3, 0, "a", "bc"), (-3, 1, "ab", "c"), (0, 0, "a", "bc"), (0, 1, "ab", "c"), (7, None, None, None), (27, 0, "", "")]
    rows += [(c, 0, "u", " \t\n") for c in range(100, 130)] + [(None, 0, "u", "no conversation")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    only = [(c, 0, "u", "gone") for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    assert [r[:7] for r in found(spark, only)] == [(only[0][0], 0, None, len(only), 0, 1, 0)]


def test_repeated_rows_are_repeated_turns(spark):
    rows = [(2, 0, "u", "again")] * 5
    assert max(r[1] for r in found(spark, rows)) == 5 - min(5, zlib.crc32(b"2") % 4)
