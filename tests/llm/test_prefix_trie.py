import hashlib
import random
import zlib

import duckdb
import pytest
from tidemark.llm import prefix_trie, radix

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations():
    rng = random.Random(8)
    texts = ["hello", "how are you", "é ü", "", "bye", "x" * 50]
    rows = []
    for c in [*range(60), 205, 206, 999_999_999_999]:
        for t in range(rng.choice([1, 2, 3, 8, 12])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(texts[:2] if t < 4 else texts)))
    rows += [(300, None, None, None), (300, 1, "user", None), (300, 1, "user", "tie"), (None, 0, "user", "lost"), (17, 0, "user", "hello")]
    rows += [(c, t, "user", f"same {t}") for c in (400, 405, 410, 411, 412) for t in range(150)]
    rows += [(c, 0, "user", "hot first turn") for c in range(1000, 1040)]
    return rows


def brute_force(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    for c, turns in own.items():
        name = {t: hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest() for t in turns}
        own[c] = [(r, x) for _, r, x in sorted(turns, key=lambda t: (t[0] is not None, t[0], name[t]))]
    again = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        again[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = {}
    for c, turns in again.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        if not children.get(node):
            leaves[node] = 1
        saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        if node:
            up = node[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[node]
            saved[up] = saved.get(up, 0) + saved[node]
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if again[c] == node)
        up = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(node), up, len(ids), children.get(node, 0), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def results(df):
    assert df.columns == NAMES and all(t == "bigint" for c, t in df.dtypes if c != "ends_sha256")
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_brute_force(spark):
    rows = conversations()
    assert results(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute_force(rows)


def test_small_segments_trees_and_pieces(spark, monkeypatch):
    """Long conversations in many segments, trees of few segments and ids in many pieces give the same."""
    for name, value in (("SEGMENT_TURNS", 3), ("TREE_SEGMENTS", 5), ("SLICE", 2), ("IDS_PER_PIECE", 4)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = [r for r in conversations() if r[0] is None or r[0] < 400 or r[1] < 20]
    assert results(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_sql_equals_brute_force():
    rows = [r for r in conversations() if r[0] is None or r[0] < 400 or r[1] < 5]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    found = con.execute(prefix_trie.ORACLE)
    order = [[d[0] for d in found.description].index(c) for c in NAMES]
    assert sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr) == brute_force(rows)


def test_empty_table_and_clashing_names(spark):
    assert results(prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA))) == []
    only_null = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert results(prefix_trie.conversation_trie(only_null)) == []
    rows = conversations()[:30]
    clashing = spark.createDataFrame([(*r, 1, "s", 2, "k") for r in rows], SCHEMA + ", POS int, size string, depth int, TEXT string")
    assert results(prefix_trie.conversation_trie(clashing)) == brute_force(rows)


@pytest.mark.parametrize("width", [1, 4])
def test_radix_tree(width):
    """All layouts, split paths, keys that begin others, and members of every aligned prefix."""
    rng = random.Random(width)
    few = [bytes([rng.randrange(256)]) * width for _ in range(3)]
    keys = [b"".join(rng.choice(few) for _ in range(rng.randrange(7))) for _ in range(200)]
    keys += [bytes([i]) * width + few[0] for i in range(256)] + [few[0] + bytes([i]) * width for i in range(40)]
    keys += [few[1] * 3 + few[2] * 40, few[1] * 3 + few[2] * 20]
    tree = radix.RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i, i % 3 + 1, 1000 - i)
    found = {}
    for row, depth, n, least in tree.aligned(width):
        prefix = keys[row][: depth * width]
        assert len(prefix) == depth * width and prefix not in found
        found[prefix] = (n, least)
    want = {}
    for i, key in enumerate(keys):
        for d in range(1, len(key) // width + 1):
            n, least = want.get(key[: d * width], (0, 1000))
            want[key[: d * width]] = (n + i % 3 + 1, min(least, 1000 - i))
    assert found == want


def test_node_layouts():
    node = radix.Node(b"", -1, 0, None)
    sizes = {}
    for i in range(256):
        node.put(255 - i, radix.Node(bytes([255 - i]), i, 1, i))
        sizes.setdefault(node.layout, i + 1)
        assert all(node.child(255 - j).row == j for j in range(i + 1)) and node.child(256 - i - 2 if i < 255 else 0) is (None if i < 255 else node.child(0))
    assert sizes == {4: 1, 16: 5, 48: 17, 256: 49}
