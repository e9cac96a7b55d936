"""The trie of conversations against brute force, in one block and cut into many."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from retailspark.llm import prefix_trie
from tests.conftest import SMALL

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_id(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute_force(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            turns[conv_id].append((turn is not None, turn or 0, turn_id(role, text), role, text))
    own = {c: [t[3:] for t in sorted(found)] for c, found in turns.items()}
    whole = {}
    for c, found in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - c % 5, [])[:h] + found[h:]
    members, children, leaves, saved, ends = (defaultdict(t) for t in (list, int, int, int, list))
    for c, found in whole.items():
        ends[tuple(found)].append(c)
        for depth in range(len(found) + 1):
            members[tuple(found[:depth])].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, inside in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(inside) - 1) * len(path[-1][1].encode()) if path else 0
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((
        (min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), children[path], leaves[path],
         saved[path], digest(ends[path])) for path, inside in members.items()
    ), key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    found = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rnd = random.Random(1)
    for c in range(1000, 1400):
        found += [(c, t or None, rnd.choice("ab"), rnd.choice(["x", "é", "", None])) for t in range(rnd.randint(0, 9))]
    found += [(c, t, "u", "same") for c in range(2000, 2600) for t in range(3)]  # one conversation many times
    return found + [(None, 1, "a", "b"), (7777, 1, None, None), (7778, 1, "a", "q"), (7778, 1, "a", "p"), (7778, 1, "a", "p"), (-3, 1, "a", "p")]


def sequences(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return prefix_trie.paths(prefix_trie.rebuilt(prefix_trie.listed(df)))


@pytest.mark.parametrize("limits", [{}, {"block": 200, "rows": 3, "chunk": 50}, {"rows": 1, "chunk": 1}])
def test_nodes_equal_brute_force(spark, rows, limits):
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    found = prefix_trie.nodes(sequences(spark, rows), **limits).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_force(rows)


def test_long_conversations_share_their_beginning(spark):
    rows = [(c, t, "u", f"t{t}" if t < 900 + c else f"own{c}") for c in range(0, 50, 5) for t in range(1000)]
    found = prefix_trie.nodes(sequences(spark, rows), rows=2).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_force(rows)


def test_no_conversations(spark):
    assert prefix_trie.nodes(sequences(spark, [])).count() == 0


def test_tree_grows_through_all_layouts():
    rnd = random.Random(2)
    keys = sorted({bytes(rnd.choices(range(256), k=20)) + b"".join(bytes(rnd.choices(range(3), k=20)) for _ in range(rnd.randint(0, 2))) for _ in range(4000)})
    root, seen = prefix_trie.build(keys), set()
    shuffled = prefix_trie.Node(keys[-1], len(keys) - 1)
    order = list(range(len(keys) - 1))
    rnd.shuffle(order)
    for number in order:
        prefix_trie.insert(shuffled, keys[number], number)

    def walk(node, above):
        path = above + node.path
        seen.add(node.kind)
        if node.key >= 0:
            yield path, node.key
        for byte, child in node.items():
            assert node.find(byte) is child
            yield from walk(child, path + bytes([byte]))

    want = [(k, i) for i, k in enumerate(keys)]
    assert list(walk(root, b"")) == want and list(walk(shuffled, b"")) == want
    assert {4, 16, 256} <= seen
    some = prefix_trie.build([bytes([b]) for b in range(30)])
    assert some.kind == 48 and [b for b, _ in some.items()] == list(range(30)) and some.find(31) is None
