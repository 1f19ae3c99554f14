"""The prefix trie of rebuilt conversations against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np

from footfall.llm import prefix_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, print string, saved string, h string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA)


def reference(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append(((turn is not None, turn or 0, reference(role, text)), (role, text)))
    convs = {c: [turn for _, turn in sorted(turns)] for c, turns in convs.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(convs.get(c - int(np.fmod(c, 100)), [])[:h] + convs[c][h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = Counter(), Counter()
    for path, found in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(found) - 1) * (len(path[-1][1]) if path else 0)
    return Counter(
        (min(found), len(path), min(nodes[path[:-1]]) if path else None, len(found), len(children[path]),
         leaves[path], saved[path], hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest())
        for path, found in nodes.items()
    )


def found(conversations):
    return Counter(
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in T.trie(conversations).collect()
    )


def talks(seed, many=260):
    rng = np.random.default_rng(seed)
    texts = ["", "yes", "no", "é漢😀", "a longer answer"]
    rows = []
    for conv in rng.choice(1000, many, replace=False).tolist():
        for turn in range(rng.integers(1, 10)):
            rows.append((conv, turn, "user" if turn % 2 else "assistant", texts[rng.integers(0, 2 + turn % 4)]))
    return rows


def test_random_talks(spark):
    rows = talks(1)
    assert found(frame(spark, rows)) == expected(rows)


def test_odd_rows(spark):
    rows = talks(2, 60)
    rows += [(None, 1, "user", "lost"), (2000, None, "user", None), (2000, 0, None, "x"), (2001, 3, "user", "same")]
    rows += [(2001, 3, "user", "same"), (2001, 3, "assistant", "other"), (-250, 1, "user", "minus"), (-200, 0, "a", "b")]
    rows += [(5000 + i, 0, "user", "hello") for i in range(90)]
    rows += [(7100, i, "user", f"turn {i}") for i in range(1300)] + [(7101, i, "user", f"turn {i}") for i in range(900)]
    rows += [(8000, 0, "u", "ab"), (8001, 0, "ua", "b"), (9001, 0, "user", "x" * 300_000)]
    assert found(frame(spark, rows).repartition(5)) == expected(rows)
    assert T.trie(frame(spark, [])).count() == 0
    assert T.trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_maps_of_prefixes_compose():
    turns = [T.turn_map(bytes([i]) * 16, 0) for i in range(12)]

    def whole(maps):
        total = T.IDENTITY
        for m in maps:
            total = T.product(total, m)
        return total

    joined = T.product(whole(turns[:3]), T.product(T.inverse(whole(turns[3:7])), whole(turns[3:])))
    assert joined == whole(turns[:3] + turns[7:])
    assert whole(turns[:2]) != whole(turns[1::-1])
    assert T.from_bytes(T.to_bytes(joined)) == joined


def test_long_conversation_is_numbered_across_partitions(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(3000)] + [(2, i, "user", f"t{i}") for i in range(50)]
    placed = T.placed(T._turns(frame(spark, rows))).collect()
    assert {(r.conv_id, r.pos) for r in placed} == {(c, i) for c, i, _, _ in rows}
    before = {(r.conv_id, r.pos): bytes(r.before) for r in placed}
    assert all(before[1, i] == before[2, i] for i in range(50))


def test_prefixes_that_meet_by_chance_are_drawn_anew(spark, monkeypatch):
    drawn = T.turn_map
    monkeypatch.setattr(T, "turn_map", lambda raw, seed: drawn(raw, seed) if seed else (1, 1))
    rows = talks(3, 20)
    turns = T._turns(frame(spark, rows))
    if T._nodes(turns, T.base_of_hundred, T.head_by_checksum, 0) is None:
        assert found(frame(spark, rows)) == expected(rows)
