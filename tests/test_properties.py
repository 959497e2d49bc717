"""Random inputs: every plan shape equals a brute-force answer."""
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import detections, locations, tuples
from rankwise.plans.jobs import (top_items, top_items_prepartitioned,
                                 top_items_skew_aware)

row = st.tuples(st.integers(1, 6),                       # location
                st.integers(1, 3),                       # camera
                st.integers(1, 40),                      # detection id (repeats)
                st.sampled_from(["a", "b", "c", "B", "é", "aa"]),
                st.integers(0, 5))                       # timestamp
lookup = st.lists(st.tuples(st.integers(1, 8), st.sampled_from(["N1", "N2", "N3"])),
                  max_size=10)


def brute_force(rows, names, top_x):
    kept = {}
    for loc, cam, det, item, ts in rows:
        key = (ts, loc, cam, item.encode())
        if det not in kept or key < kept[det][0]:
            kept[det] = (key, (loc, item))
    counts = Counter(v for _, v in kept.values())
    best_name = {}
    for k, v in names:
        best_name[k] = max(best_name.get(k, v), v)
    per_loc = defaultdict(list)
    for (loc, item), n in counts.items():
        per_loc[loc].append((-n, item.encode(), item))
    out = []
    for loc, entries in per_loc.items():
        for rank, (_, _, item) in enumerate(sorted(entries)[:top_x], start=1):
            out.append((loc, best_name.get(loc), rank, item))
    return sorted(out, key=repr)


@settings(max_examples=10, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, max_size=60), names=lookup, top_x=st.integers(0, 4))
def test_all_shapes_match_brute_force(spark, rows, names, top_x):
    d, loc = detections(spark, rows), locations(spark, names)
    want = brute_force(rows, names, top_x)
    assert tuples(top_items(d, loc, top_x)) == want
    assert tuples(top_items(d, loc, top_x, salts=3)) == want
    assert tuples(top_items_skew_aware(d, loc, top_x)[0]) == want
    assert tuples(top_items_skew_aware(d, loc, top_x, reducers=1000)[0]) == want
    assert tuples(top_items_prepartitioned(d, loc, top_x)) == want
