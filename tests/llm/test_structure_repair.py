"""Conversation repair: block tables against plain search, the whole operator
against a plain version, odd rows, very long conversations."""
import hashlib
import itertools
import random
import re
import zlib

import pytest

from conftest import SF_CHECK
from rankwise.llm import structure_repair as s

LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(kinds):
    """Least (cost, audit, output initials) by trying everything from the front:
    per prefix and pattern state the least cost and then the least audit."""
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        for _ in range(3):
            for (state, _), (cost, audit, out) in list(best.items()):
                x = "u" if state != "u" else "a"
                new = (cost + 5, audit + "I", [*out, (x, None)])
                if (x, 0) not in best or new[:2] < best[x, 0][:2]:
                    best[x, 0] = new
        return best
    best = inserted({("", 0): (0, "", [])})
    for at, (initial, fault) in enumerate(kinds):
        new = {}
        for (state, _), (cost, audit, out) in best.items():
            found = [("D", 2, state, out)]
            if fault in ("fine", "truncated"):
                more = 5 * (fault == "truncated")
                if initial in step[state]:
                    found.append(("K", more, initial, [*out, (initial, at)]))
                x = "u" if state != "u" else "a"
                found.append(("R", 1 + more, x, [*out, (x, -1 - at)]))
            for edit, price, to, result in found:
                option = (cost + price, audit + edit, result)
                if (to, 0) not in new or option[:2] < new[to, 0][:2]:
                    new[to, 0] = option
        best = inserted(new)
    return min((best[q, 0] for q in ("", "a") if (q, 0) in best), key=lambda x: x[:2])


def plain(rows, damaged):
    """{conv: result} of (conv, turn, role, text) rows, one conversation at a time."""
    space = [tuple(" " if v is None else v for v in r) for r in rows]
    groups = {r[0]: [] for r in rows}
    for (conv, turn, _, _), (c, t, role, text) in zip(rows, space):
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20 if damaged else 19
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        groups[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)

    def digest(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
    out = {}
    for conv, turns in groups.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[1], r[2])))
        kinds, seen = [], set()
        for _, role, text in turns:
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else \
                "fine" if visible[-1] in ".!?" else "truncated"
            seen.add((role, text))
            kinds.append((role[:1], fault))
        known = [t for t, _, _ in turns if t is not None]
        cost, audit, result = cheapest([(i if i in tuple("sua") else "-", f) for i, f in kinds])
        assert LEGAL.fullmatch("".join(x for x, _ in result))
        names = {"u": "user", "a": "assistant"}
        text = "\n".join(f"{names[x]}:" if at is None else f"{turns[at][1]}:{turns[at][2]}"
                         if at >= 0 else f"{names[x]}:{turns[-1 - at][2]}" for x, at in result)
        faults = [f for _, f in kinds]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0,
                     faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au")
                         for (a, _), (b, _) in itertools.pairwise(kinds)),
                     cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


KINDS = [(i, f) for f in ("fine", "truncated") for i in "sua-"] + [("s", "blank")]


@pytest.mark.parametrize("size", [1, 3, 4])
def test_block_tables_equal_plain_search(size):
    made, rnd = s.tables(size), random.Random(size)
    short = [list(x) for n in range(4) for x in itertools.product(range(9), repeat=n)]
    long = [[rnd.randrange(9) for _ in range(rnd.randrange(4, 60))] for _ in range(150)]
    for classes in short + long:
        assert made.repair(bytes(classes)) == cheapest([KINDS[k] for k in classes])[:2]


def test_the_vectors_are_few():
    assert len(s.tables().vectors) < 50


def test_query_on_tables_equals_plain_version(spark):
    table = spark.read.parquet(f"{SF_CHECK}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    out = s.damaged_repairs(table)
    assert out.dtypes == [("conv_id", "bigint"), *[(c, "bigint") for c in
                          ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                          ("audit", "string"), ("repaired_sha256", "string")]
    got = found(out)
    assert got == plain(rows, True)
    assert out.count() == len(got)


SCHEMA = "conv_id long, turn long, role string, text string, `a.b` int, letter int, place int"


def odd_rows():
    rnd, rows = random.Random(11), []
    for conv in [*range(60), None, -7]:
        for _ in range(rnd.randrange(1, 12)):
            rows.append((conv, rnd.choice([None, 0, 1, 1, 2, 3, 9]),
                         rnd.choice(["user", "assistant", "system", "User", "", None, "tool", "ü"]),
                         rnd.choice(["Yes.", "No", " ", "", None, "A!\n", "x" * 9, ". \t", "é?", "Yes."])))
    return rows


@pytest.mark.parametrize("damaged", [True, False])
def test_nulls_ties_repeats_and_clashing_names(spark, damaged):
    rows = odd_rows()
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    got = found((s.damaged_repairs if damaged else s.repairs)(table, chunk=3))
    assert got == plain(rows, damaged)


def test_everything_dropped_and_no_rows(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    table = spark.createDataFrame([(1, gone, "user", "Hi.")],
                                  "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert found(s.damaged_repairs(table)) == {1: (0, 0, 0, 0, 0, 0, "", empty)}
    assert s.damaged_repairs(table.limit(0)).collect() == []


@pytest.mark.parametrize("id_type", ["string", "int", "smallint", "date"])
def test_other_id_types(spark, id_type):
    table = spark.createDataFrame(odd_rows()[:40], "conv_id long, turn long, role string, text string")
    ids = {"date": "date_add(date'2020-01-01', cast(conv_id as int))"}.get(id_type, "conv_id")
    table = table.selectExpr(f"cast({ids} as {id_type}) as conv_id", "turn", "role", "text")
    got = found(s.repairs(table))
    assert got == plain([tuple(r) for r in table.collect()], False)


def test_a_conversation_with_most_of_the_rows(spark):
    """It spans ranges, chunks and blocks; long texts ride along."""
    rnd = random.Random(5)
    rows = [(1, t, rnd.choice(["user", "assistant", "assistant"]), rnd.choice(["Ok.", f"{t}.", f"{t}"]))
            for t in range(6000)] + [(c, 0, "user", "z" * 300_000 + ".") for c in range(2, 30)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = found(s.repairs(table.repartition(16), chunk=500))
    assert got == plain(rows, False)
