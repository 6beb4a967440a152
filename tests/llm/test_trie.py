"""The conversation trie against plain dictionaries."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from attestra.llm import radix
from attestra.llm.common import prepared
from attestra.llm.conversation_trie import prefix_trie, turns_of
from attestra.llm.queries import ORACLE, QUERIES
from tests import oracle
from tests.llm.conftest import SF_DIR

FIELDS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in ("path", "parent", "depth", "at", "id", "what", "run")]
)


def plain_turns(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            out[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x, key=lambda y: (y[0], y[1], y[2].encode(), y[3].encode()))] for c, x in out.items()}


def plain_trie(sequences):
    """``FIELDS`` of every node of ``{conv_id: [(role, text)]}``."""
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids[node]
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0) + sum(saved[k] for k in below)
        leaves[node] = sum(leaves[k] for k in below) or 1
    return Counter(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(kids[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def found(df):
    return Counter(tuple(r[f] for f in FIELDS) for r in df.collect())


def conversations(seed, count):
    """Few distinct turns, so prefixes are shared; one conversation held by a third of all, and a very long one."""
    rng = random.Random(seed)
    hot = [("user", "hello"), ("assistant", "what can I do?")]
    rows = []
    for c in range(count):
        turns = hot[: rng.randint(1, 2)] if rng.random() < 0.3 else []
        turns = turns + [(rng.choice(["user", "assistant", ""]), rng.choice(["a", "b", "", "ä"])) for _ in range(rng.randint(0 if turns else 1, 5))]
        rows += [(c * 3 - 40, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(10_001, k, "user", str(k % 7)) for k in range(700)] + [(10_002, k, "user", str(k % 7)) for k in range(650)]
    rows += [(5, None, "user", "first"), (5, 1, None, None), (5, 1, None, None), (6, 2, "b", "x"), (6, 2, "a", "y"), (None, 1, "user", "nobody"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return prepared(spark).createDataFrame([(*r, *["x"] * 7) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("conversations_a_block, group", [(2048, 256), (7, 2), (1, 3), (50, 2)])
def test_trie(spark, conversations_a_block, group):
    rows = conversations(conversations_a_block, 160)
    got = found(prefix_trie(turns_of(frame(spark, rows)), conversations=conversations_a_block, group=group))
    want = plain_trie(plain_turns(rows))
    assert got == want


def test_conversations_without_turns_and_none_at_all(spark):
    schema = "conv_id long, turns array<string>"
    assert prefix_trie(prepared(spark).createDataFrame([], schema)).count() == 0
    assert turns_of(frame(spark, [])).count() == 0
    got = found(prefix_trie(spark.createDataFrame([(4, []), (9, []), (-3, [])], schema)))
    assert got == plain_trie({4: [], 9: [], -3: []})


def test_hot_leaf_is_digested_over_many_blocks(spark):
    rows = [(c, 0, "user", "the same") for c in range(5_000)] + [(9_000, 0, "user", "the same"), (9_000, 1, "user", "more")]
    got = found(prefix_trie(turns_of(frame(spark, rows)), conversations=100, group=2))
    assert got == plain_trie(plain_turns(rows))


@pytest.mark.parametrize("children", [1, 4, 5, 16, 17, 48, 49, 256])
def test_layouts_grow(children):
    tree = radix.Tree()
    keys = [bytes([k]) + bytes(15) for k in range(children)]
    for k, key in enumerate(keys):
        tree.add(key, k)
        tree.add(key, 1000 + k)
    layout = tree.root.children
    assert type(layout) is next(x for x in (radix.Layout4, radix.Layout16, radix.Layout48, radix.Layout256) if children <= x.room)
    assert [b for b, _ in layout] == list(range(children)) and all(layout.get(k).ends == [k, 1000 + k] for k in range(children))
    assert layout.get(children % 256) is None or children == 256


def test_depths_inside_a_turn_give_no_nodes():
    tree = radix.Tree()
    a, b = bytes(8) + b"a" * 8, bytes(8) + b"b" * 8  # half of the id is shared
    for member, key in enumerate([a, a + a, a + b, b]):
        tree.add(key, member)
    finished, still_open = radix.prefixes(tree, a, b)
    assert sorted(p.depth for p in finished + still_open) == [0, 1, 1, 2, 2]
    done, left = radix.stitch([still_open], whole=True)
    assert not left and {p.depth: p.n_convs for p in done} == {0: 4, 1: 1} or sorted((p.depth, p.n_convs) for p in done) == [(0, 4), (1, 1), (1, 3)]


def test_rebuilt_conversations(spark):
    raw = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    own = plain_turns(raw)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    df = QUERIES["op12_radix_trie"](spark, SF_DIR)
    assert found(df) == plain_trie(rebuilt)
    con = oracle.connect(SF_DIR)
    assert oracle.compare(df, con, ORACLE["op12_radix_trie"]) is None and oracle.compare_types(df, con, ORACLE["op12_radix_trie"]) is None
