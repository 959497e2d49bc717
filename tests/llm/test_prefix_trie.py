"""The burst trie against a plain trie, with containers of many sizes."""
import hashlib
import random
import zlib

import pytest

from conftest import SF_CHECK
from rankwise.llm import prefix_trie as p


def plain(rows):
    """Nodes of the rebuilt conversations, by dictionaries of whole prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in own.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(
            f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16]))
        own[conv] = [r[1:] for r in turns]
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    return nodes_of(built)


def nodes_of(built):
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out, children, below = [], {}, {}
    for prefix in members:
        if prefix:
            children[prefix[:-1]] = children.get(prefix[:-1], 0) + 1
    for prefix in sorted(members, key=len, reverse=True):
        leaves, saved = below.get(prefix, (0, 0))
        leaves = leaves or 1
        if prefix:
            saved += (len(members[prefix]) - 1) * len(prefix[-1][1].encode())
            up = below.get(prefix[:-1], (0, 0))
            below[prefix[:-1]] = up[0] + leaves, up[1] + saved
        ends = sorted(c for c in members[prefix] if len(built[c]) == len(prefix))
        out.append((min(members[prefix]), len(prefix),
                    min(members[prefix[:-1]]) if prefix else None, len(members[prefix]),
                    children.get(prefix, 0), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, `a.b` int, pos int, depth int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


def test_query_on_tables_equals_plain_trie(spark):
    df = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    want = plain(rows)
    out = p.trie(df)
    assert out.dtypes == [(c, "bigint") for c in (
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens")] + [("ends_sha256", "string")]
    assert found(out) == want
    assert found(p.trie(df, container_turns=60)) == want


def odd_rows(seed, convs):
    rnd, rows = random.Random(seed), []
    for conv in [*range(-12, convs), None]:
        for _ in range(rnd.choice([1, 2, 3, 9, 14])):
            rows.append((conv, rnd.choice([None, 0, 1, 2, 2, 3, 7]), rnd.choice(["user", None, "a"]),
                         rnd.choice([None, "", "é", "yes", "no" * 40])))
    return rows


@pytest.mark.parametrize("limit", [2, 40])
def test_containers_of_any_size_give_the_same_nodes(spark, limit):
    rows = odd_rows(limit, 40)
    assert found(p.trie(table(spark, rows), container_turns=limit)) == plain(rows)


def test_copies_long_conversations_and_long_texts(spark):
    """Many copies of one conversation, and long ones that become chains."""
    rows = [(5 * c, t, "user", "hello" * (t + 1)) for c in range(150) for t in range(3)]
    rows += [(c, t, "x", f"{c // 10}-{t}") for c in (1000, 1005, 1010) for t in range(400)]
    rows += [(2000, 0, "user", "w" * 400_000)]
    assert found(p.trie(table(spark, rows), container_turns=50)) == plain(rows)


def test_chains_sum_over_runs(spark, monkeypatch):
    """Two copies of a long conversation: savings are sums over several runs."""
    monkeypatch.setattr(p, "RUN_BITS", 3)
    rows = [(c, t, f"{t}", "b" * t) for c in (5, 20) for t in range(60)]
    df = spark.createDataFrame([(c, t, f"{t}".encode(), t) for c, t, _, _ in rows],
                               "conv long, pos int, tid binary, n_bytes int")
    got = found(p.prefix_nodes(df, df.select("conv").distinct(), 7))
    built = {c: tuple((r, x) for k, _, r, x in rows if k == c) for c in (5, 20)}
    assert got == nodes_of(built)


def test_ids_of_many_copies_are_written_by_ranges(spark):
    ids = [*range(5), 2**16 - 1, 2**16, 3 * 2**16 + 5, -1, -(2**17)]
    every = spark.createDataFrame([(i,) for i in ids], "conv long")
    none = spark.createDataFrame([], "conv long, pos int, tid binary, n_bytes int")
    [row] = p.distinct_conversations(none, every).collect()
    text = ",".join(map(str, sorted(ids)))
    assert tuple(row) == (min(ids), len(ids), 0, hashlib.sha256(text.encode()).hexdigest())


def test_turnless_conversations_and_no_rows(spark):
    """A conversation whose own turns all lie in the part it takes from one that is
    not there has no turns: it ends at the root."""
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "gone")]
    got = found(p.trie(table(spark, rows)))
    assert got == plain(rows) and len(got) == 1 and got[0][1] == 0
    assert p.trie(table(spark, rows).limit(0)).collect() == []
    assert p.trie(table(spark, [(None, 1, "user", "x")])).collect() == []
