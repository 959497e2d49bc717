"""Pseudonyms: permutations, formats, links between documents, round trips."""
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankwise.llm import pii as p

KEY = b"a test key"
CARD, SPACED = "4263429643439180", "4263 4296 4343 9180"


def one(text, key=KEY):
    return p.replace(text, key)[0]


@given(st.integers(1, 400), st.text(max_size=5))
@settings(max_examples=30, deadline=None, derandomize=True)
def test_permutation(size, tweak):
    image = [p.permute(KEY, tweak, size, v) for v in range(size)]
    assert sorted(image) == list(range(size))
    assert [p.permute(KEY, tweak, size, v, True) for v in image] == list(range(size))


@pytest.mark.parametrize(("value", "pattern"), [
    (CARD, r"[1-9]\d{15}"), (SPACED, r"[1-9]\d{3}( \d{4}){3}"), ("378282246310005", r"\d{15}"),
    ("DE89 3704 0044 0532 0130 00", r"DE\d\d( \d{4}){4} \d\d"),
    ("GB82WEST12345698765432", r"GB\d\d[A-Z]{4}\d{14}"),
    ("97.51.17.173", r"\d{1,3}(\.\d{1,3}){3}"), ("+1 (017) 555-7713", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
    ("(212) 555-0199", r"\(\d{3}\) \d{3}-\d{4}"), ("+491701234567", r"\+\d{12}"),
    ("078-05-1120", r"\d{3}-\d\d-\d{4}"), ("2024-02-29", r"\d{4}-\d\d-\d\d"),
    ("29.02.2024", r"\d\d\.\d\d\.\d{4}"), ("12/31/1999", r"\d\d/\d\d/\d{4}"),
    ("31/12/1999", r"(1[3-9]|[23]\d)/\d\d/\d{4}"),
    ("und.34@mail7.example.com", r"[a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com")])
def test_formats(value, pattern):
    for text in (value, f"x {value}.", f"({value}), y", f"{value}!!"):
        new, found = p.replace(text, KEY)
        at = text.index(value)
        assert [x[1:] for x in found] == [(at, at + len(value))]
        inner = new[at:len(new) - len(text) + at + len(value)]
        assert re.fullmatch(pattern, inner) and inner != value
        assert new.replace(inner, value) == text
        assert p.replace(new, KEY, True)[0] == text
        assert one(text, b"another") != new


# Values and what their pseudonyms must look like, written apart from the patterns.
PLANTED = [
    ("1985-04-12T10:00:00Z", r"(19|20)\d\d-[01]\d-[0-3]\dT10:00:00Z"),
    ("1985/04/12", r"(19|20)\d\d/[01]\d/[0-3]\d"), ("4/12/1985", r"\d{1,2}/\d{1,2}/(19|20)\d\d"),
    ("3.7.1999", r"\d{1,2}\.\d{1,2}\.(19|20)\d\d"), ("12 April 1985", r"[1-3]\d [A-Z][a-z]+ (19|20)\d\d"),
    ("5 May 2001", r"[1-9] [A-Z][a-z]+ (19|20)\d\d"), ("April 12, 1985", r"[A-Z][a-z]+ [1-3]\d, (19|20)\d\d"),
    ("03 Feb 1972", r"0[1-9] [A-Z][a-z]{2} (19|20)\d\d"), ("12. März 1985", r"[1-3]\d\. [A-Z][a-zä]+ (19|20)\d\d"),
    ("12 avril 1985", r"[1-3]\d [a-zéû]+ (19|20)\d\d"), ("1 de abril de 1985", r"[1-9] de [a-z]+ de (19|20)\d\d"),
    ("+33 1 23 45 67 89", r"\+33 \d( \d\d){4}"), ("+34 612 34 56 78", r"\+34 \d{3}( \d\d){3}"),
    ("+34 612 345 678", r"\+34 \d{3}( \d{3}){2}"), ("+49 30 12345678", r"\+49 \d\d \d{8}"),
    ("01 23 45 67 89", r"0\d( \d\d){4}"), ("555 123 4567", r"\d{3} \d{3} \d{4}"),
    ("2001:db8::ff00:42:8329", r"[0-9a-f:]+"), ("FE80::1ff", r"[0-9A-Fa-f:]+"),
    ("2001:0db8:0000:0000:0000:ff00:0042:8329", r"[0-9a-f]{4}(:[0-9a-f]{4}){7}"),
    ("078 05 1120", r"\d{3} \d\d \d{4}"),
]


@pytest.mark.parametrize(("value", "shape"), PLANTED)
@pytest.mark.parametrize("key", [KEY, b"2", b"third", b"4th"])
def test_planted_values(value, shape, key):
    for before, after in (("", ""), ("on ", "."), ("(", ") x"), ("seen: ", ", then")):
        new, found = p.replace(before + value + after, key)
        assert len(found) == 1 and new.startswith(before) and new.endswith(after)
        inner = new[len(before):len(new) - len(after)]
        assert re.fullmatch(shape, inner) and inner != value
        assert p.replace(new, key, True)[0].lower() == (before + value + after).lower()


def test_one_number_in_two_notations():
    assert one("+33 1 23 45 67 89")[4:] == one("01 23 45 67 89")[1:]


def test_neighbours():
    for text in (f"7 {CARD}", f"7 {SPACED} 12", f"{CARD} {CARD}", f"1234 {SPACED}",
                 "DE89 3704 0044 0532 0130 00 IN 97.51.17.173 8", "5 +1 (017) 555-7713 97.51.17.173"):
        new, found = p.replace(text, KEY)
        assert found and not any(v in new for v in (CARD, SPACED, "97.51.17.173", "555-7713", "3704"))


def test_equal_values_stay_linked():
    assert one(SPACED).replace(" ", "") == one(CARD) == one(f"see {CARD}")[4:]
    iso, german = one("2021-03-04"), one("04.03.2021")
    assert iso.split("-") == german.split(".")[::-1]


@pytest.mark.parametrize("text", [
    "4263429643439181", "2021-02-30", "300.1.1.1", "1.2.3", "DE89370400440532013001",
    "000-12-3456", "666-12-3456", "version 3.", "Version 2.0.", "a1b2", "x@y", "12345", "",
    "12345678901234567890123", "10 200 3000", "deadbeef4263429643439180", "10 20 30 40",
    "10:00:00", "std::string 7", "::1", "in May 2000 words", "31 April 1985", "5 apples 1999",
    "1 23 45 67 89 10", "12 555 123 4567", "13/13/1985", "0/4/1985"])
def test_what_is_not_valid_stays(text):
    assert p.replace(text, KEY) == (text, [])


def test_rows(spark):
    rng = random.Random(9)
    values = [CARD, "97.51.17.173", "+1 (017) 555-7713", "a.b@mail7.example.com", "2020-01-31"]
    rows = [(i, " ".join(rng.choice([*values, "word", "7", "é"]) for _ in range(30)), "x")
            for i in range(50)]
    rows += [(60, None, None), (61, "", "x"), (None, CARD, "x"), (0, rows[0][1], "x"),
             (62, "plain words " * 50_000 + CARD, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_found string")
    out = p.pseudonymise(df, KEY)
    assert out.columns == ["doc_id", "text", "pii_found", "_pii_found"]
    got = out.collect()
    want = [(i, *p.replace(t, KEY), f) for i, t, f in rows]
    assert sorted(((r[0], r[1], [tuple(x) for x in r[3]], r[2]) for r in got), key=repr) \
        == sorted(want, key=repr)
    assert not any(v in (r.text or "") for r in got for v in values)
    back = p.restore(out.drop("_pii_found"), KEY).select("doc_id", "text")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted((r[:2] for r in rows), key=repr)
    assert p.pseudonymise(spark.createDataFrame([], df.schema), KEY).count() == 0
