"""The burst trie against plain prefixes, at container sizes that burst often and never."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexigrain.llm import turn_trie

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, ids string, heads string, container string"


def nodes_of(sequences):
    """Every prefix with its members, from a dictionary conv_id -> list of (turn, points)."""
    members = defaultdict(list)
    for conv_id, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv_id)
    out = set()
    for prefix, convs in members.items():
        depth = len(prefix)
        below = [p for p in members if p[:depth] == prefix]
        parents = {p[:-1] for p in members if p}
        ends = sorted(c for c in convs if len(sequences[c]) == depth)
        out.add((
            min(convs), depth, min(members[prefix[:-1]]) if depth else None, len(convs),
            sum(len(p) == depth + 1 for p in below), sum(p not in parents for p in below),
            sum((len(members[p]) - 1) * p[-1][1] for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def rebuilt_of(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [((role, text), len(text)) for *_, role, text in sorted(found)] for c, found in turns.items()}
    out = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = abs(c) - abs(c) % 100
        out[c] = own.get(first if c >= 0 else -first, [])[:h] + found[h:]
    return out


def conversations(seed, size, alphabet=3, most=7):
    draw = random.Random(seed)
    return {c: [(f"t{draw.randrange(alphabet)}", 0) for _ in range(draw.randint(0, most))] for c in range(size)}


def sequence_rows(spark, sequences):
    rows = [(c, [t.encode().ljust(16) for t, _ in s], [p for _, p in s]) for c, s in sequences.items()]
    return spark.createDataFrame(rows, "conv_id long, ids array<binary>, points array<int>")


def found_nodes(frame):
    rows = [tuple(row) for row in frame.select(*NODE).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("limit", [1, 40, 8192])
def test_bursting_gives_every_node(spark, limit):
    sequences = conversations(5, 150)
    # Long shared runs, sequences that end inside and at the end of such a run, and one that stands alone.
    chain = [(f"c{at}", 0) for at in range(12)]
    for at in range(30):
        sequences[1000 + at] = chain[: 4 + at % 9] + [(f"x{at % 5}", 0)] * (at % 3)
    sequences[2000] = [("alone", 0)] * 300
    sized = {c: [(t, len(t) + at) for at, (t, _) in enumerate(s)] for c, s in sequences.items()}
    # Points belong to the turn: make them a function of it.
    sized = {c: [(t, 7 * len(t) + ord(t[1])) for t, _ in s] for c, s in sized.items()}
    assert found_nodes(turn_trie.trie_nodes(sequence_rows(spark, sized), limit)) == nodes_of(sized)


def test_members_of_several_blocks(spark):
    sequences = {c: [("hot", 3), ("turn", 4)] for c in range(-300, 1200)} | {5000: [("hot", 3)], 5001: []}
    for limit in (1, 8192):
        assert found_nodes(turn_trie.trie_nodes(sequence_rows(spark, sequences), limit)) == nodes_of(sequences)


def test_rebuilt_conversations(spark):
    draw = random.Random(3)
    rows = []
    for c in [*range(0, 260, 3), 200, 300, -5, -100, -104]:
        for turn in range(draw.randint(1, 7)):
            text = draw.choice(["hi", "", None, "a\nb", "é" * 5, "long " * 4000])
            rows.append((c, draw.choice([turn, None]) if turn == 0 else turn, draw.choice(["user", "assistant", None]), text, "x", "y", "z"))
    rows += [rows[0], rows[1]]  # repeated rows are turns of their own
    rows += [(None, 0, "user", "nobody's", "x", "y", "z")]
    rows += [(650, 0, "user", "one turn, and no first conversation in its group", "x", "y", "z")]
    frame = spark.createDataFrame(rows, SCHEMA)
    # Equal turn numbers are ordered by turn id, which the plain version does not know: leave out such conversations.
    ties = {r[0] for r in rows if sum(q[0] == r[0] and q[1] == r[1] and q != r for q in rows)}
    kept = [r for r in rows if r[0] not in ties]
    found = turn_trie.rebuilt_trie(frame.where(~F.coalesce(F.col("conv_id"), F.lit(-1)).isin([*ties, 10**9])), 30)
    assert found_nodes(found) == nodes_of(rebuilt_of(kept))
    assert turn_trie.rebuilt_trie(frame).count() > 0
    assert turn_trie.rebuilt_trie(frame.limit(0)).count() == 0


def test_turnless_conversation(spark):
    # crc32("112") % 6 > 0, so its only turn is replaced by those of conversation 100, which is absent.
    assert zlib.crc32(b"112") % 6 > 0
    frame = spark.createDataFrame([(112, 0, "user", "gone", "", "", "")], SCHEMA)
    assert found_nodes(turn_trie.rebuilt_trie(frame)) == nodes_of({112: []})
