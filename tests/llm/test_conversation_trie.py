"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from tallyline.llm import conversation_trie, registry
from tallyline.llm.storage import show_package

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest_of(turn):
    role, text = turn
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def rebuilt(rows):
    """{conv_id: turns} of rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t for *_, t in sorted(x, key=lambda y: (y[:2], digest_of(y[2])))] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    return out


def plain_trie(whole):
    """The rows of all nodes."""
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    rows = []
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if len(whole[c]) == len(node))))
        rows.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
            len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def rows_of(found):
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=str)


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(9)
    rows = []
    for c in range(0, 900, 3):
        for turn in range(draw.choice([1, 2, 3, 8])):
            rows.append((c, turn, draw.choice(["user", "assistant"]), draw.choice(["", "hi", "yes é漢", "no"])))
    for c in range(1000, 1300):  # copies of one conversation, a third of all
        rows += [(c, t, "user", f"same {t}") for t in range(12)]
    rows += [(5001, t, "user", f"long {t % 7}") for t in range(300)]
    rows += [
        (7, 1, None, None), (7, 1, "", ""), (7, None, "x", "null turn first"), (7, 1, "user", "tie"), (7, 1, "user", "tie"),
        (None, 1, "user", "of nobody"), (8, 5, "user:", "1"), (9, 5, "user", ":1"), (100_000, 0, "user", "a head alone"),
    ]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("ranges", [1, 3, 40, None])
def test_same_nodes_as_a_plain_trie(spark, talks, ranges):
    show_package(spark)
    table = spark.createDataFrame([(*r, "x", 1) for r in talks], f"{SCHEMA}, path string, shard int").repartition(4)
    assert rows_of(conversation_trie.conversation_trie(table, ranges)) == plain_trie(rebuilt(talks))


def test_splitters_part_equal_and_long_paths(spark, talks, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SPLITTER_TURNS", 5)
    monkeypatch.setattr(conversation_trie, "PIECE_IDS", 7)
    table = spark.createDataFrame(talks, SCHEMA)
    assert rows_of(conversation_trie.conversation_trie(table, 30)) == plain_trie(rebuilt(talks))
    own = conversation_trie.rebuilt(conversation_trie.paths(table))
    monkeypatch.setattr(conversation_trie, "SPLITTER_TURNS", 64)
    cuts = conversation_trie._splitters(own, 30)
    hot = max({p for p, _, _ in cuts}, key=[p for p, _, _ in cuts].count)
    assert sum(p == hot for p, _, _ in cuts) > 5  # equal conversations lie in several ranges


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_trie.conversation_trie(empty).collect() == []
    # h of 3 and 12 leaves nothing of a single turn, since no conversation 0 lends its first ones.
    rows = [(c, 0, "user", "x") for c in (3, 12, 20, 21)]
    assert rows_of(conversation_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rebuilt(rows))
    assert any(not turns for turns in rebuilt(rows).values())


def test_query_agrees_with_its_sql_and_a_plain_trie(spark, sf):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    found = rows_of(registry.op13_conversation_trie(spark, sf))
    sql = db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({registry.all_oracles()['op13_conversation_trie']})")
    assert found == sorted(sql.fetchall(), key=str)
    rows = db.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert found == plain_trie(rebuilt(rows))
