"""The prefix trie against brute force: long and hot conversations, copies, ties, odd rows, and contraction of odd shapes."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from tallyloom.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, depth int"


def brute(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            said[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [x for _, x in sorted(v, key=lambda x: x[0])] for c, v in said.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(base, [])[:h] + own[c][h:] if base != c else own[c]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = (defaultdict(int) for _ in range(3))
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        if node:
            for x in (leaves, saved):
                x[node[:-1]] += x[node]
            kids[node[:-1]] += 1
    return {
        (members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), kids[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n in members
    }


def found(spark, rows):
    df = prefix_trie.prefix_trie(spark.createDataFrame([(*r, "other", 3) for r in rows], SCHEMA))
    out = df.collect()
    assert len(out) == len({tuple(r) for r in out})
    return {tuple(r) for r in out}


def test_odd_rows(spark):
    rows = [(c, t, "user", f"says {t if t < 3 else c}") for c in range(40) for t in range(c % 7)]
    rows += [(c, t, "user", f"says {t}") for c in (50, 51, 52, 53) for t in range(6)]
    rows += [(None, 0, "user", "x"), (60, None, None, None), (60, None, "a", ""), (61, 0, "", None), (62, 3, "user", "é" * 5000)]
    rows += [(70, 1, "user", "again")] * 4 + [(71, 1, "user", "tie one"), (71, 1, "user", "tie two"), (-7, 0, "user", "below"), (-5, 0, "user", "zero"), (-5, 1, "user", "one")]
    rows += [(80, 0, "us", "er"), (85, 0, "u", "ser")]  # equal when joined, yet not equal
    rows += [(91, 0, "user", "gone"), (97, 0, "user", "gone")]  # without a base, and taken over in whole
    want = brute(rows)
    assert found(spark, rows) == want
    assert any(r[3] > r[4] + 1 for r in want)


def test_long_conversations_lie_across_parts(spark):
    """One conversation with most rows, copies of it, and one that goes on alone: far deeper than any number of rounds."""
    long = [(c, t, "user", f"turn {t}") for c in (0, 5, 10) for t in range(300 + (c == 5) * 200)]
    rows = long + [(15, t, "user", f"turn {t}") for t in range(150)] + [(c, 0, "user", "turn 0") for c in range(20, 60)]
    assert found(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert found(spark, []) == set()
    assert found(spark, [(5, 1, "a", "b")]) == brute([(5, 1, "a", "b")])


@pytest.mark.parametrize("shape", ["star", "caterpillar", "binary", "chains"])
def test_totals(spark, shape):
    n = 200
    parent = {"star": lambda i: 0, "caterpillar": lambda i: i - 1 - (i % 2 == 0 and i > 1), "binary": lambda i: (i - 1) // 2, "chains": lambda i: max(0, i - 3)}[shape]
    rows = [(i.to_bytes(16, "big"), parent(i).to_bytes(16, "big") if i else None, i * i) for i in range(n)]
    want = [i * i for i in range(n)]
    for i in range(n - 1, 0, -1):
        want[parent(i)] += want[i]
    got = prefix_trie.subtree_totals(spark.createDataFrame(rows, "node binary, parent binary, w bigint"), ("w",))
    assert {int.from_bytes(r.node, "big"): r.w for r in got.collect()} == dict(enumerate(want))


def test_pieces_of_ids(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(b"a", c) for c in range(5, 200)] + [(b"b", c) for c in range(7)] + [(b"c", 10**12)]
    got = prefix_trie.digests(spark.createDataFrame(rows, "node binary, conv bigint").repartition(9))
    want = {n: hashlib.sha256(",".join(str(c) for m, c in rows if m == n).encode()).hexdigest() for n in (b"a", b"b", b"c")}
    assert {bytes(r.node): r.ends_sha256 for r in got.collect()} == want
