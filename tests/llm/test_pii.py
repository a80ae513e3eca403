import hashlib
import re
import time

from framelake.llm import pii
from hypothesis import given, settings
from hypothesis import strategies as st

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The base kinds by their patterns alone."""
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    found = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return found + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


SAMPLES = [
    "mail a.b%c+d-e@x-y.example.com, or @nobody and a@b and x@y.z.", "a@b@c.de @x.y", "1.2.3.4.5 and 999.1.1.1 1.2.3 10.0.0.255 0001.2.3.4",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "+1 (415) 555-2671 and +123 and +44 20 7946 0958 x", "é" * 5 + "a@b.cd" + "😀 1.1.1.1", "", "@", "..@..", "5" * 300,
]


def test_base_spans_equal_the_patterns():
    for text in SAMPLES:
        assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE] == plain(text), text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="01249.@+- ()aZé%_\n", max_size=60))
def test_base_spans_equal_the_patterns_on_any_text(text):
    assert [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE] == plain(text)


def test_checksums_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert kinds("my iban is GB82 WEST 1234 5698 7654 32 ok") == ["iban"]
    assert kinds("my iban is GB82 WEST 1234 5698 7654 31 ok") == []
    assert kinds("call (017) 555-5036 now") == ["local_phone"] and kinds("version (017) 555-5036 now") == []
    assert kinds("visa card 378282246310005") == ["short_card"] and kinds("378282246310005") == []


def test_long_texts_take_linear_time():
    assert pii.find_spans("9" * 200_000) == []
    assert len(pii.find_spans("a" * 100_000 + "@b.c")) == 1


def overlaps_by_pairs(added, found):
    return [x for x in added if not any(x[1] < e and s < x[2] for _, s, e, _ in found)]


SPAN = st.tuples(st.integers(0, 60), st.integers(1, 20)).map(lambda x: ("k", x[0], x[0] + x[1], False))


@settings(max_examples=400, deadline=None)
@given(st.lists(SPAN, max_size=12), st.lists(SPAN, max_size=12))
def test_added_spans_stand_apart_from_found_ones(added, found):
    assert pii._apart(added, found) == overlaps_by_pairs(added, found)


def test_long_contact_lists_take_linear_time():
    line = "write to someone@example.org or call (017) 555-5036 now\n"
    started = time.perf_counter()
    spans = pii.find_spans(line * (2_000_000 // len(line)))
    assert len(spans) == 2 * (2_000_000 // len(line)) and time.perf_counter() - started < 10


def test_query_rows(messy, strange, empty):
    from pyspark.sql import functions as F

    texts = F.when(F.col("doc_id") == 5, "me@x.org 4111 1111 1111 1111").otherwise(F.col("text"))
    for df in (messy, strange):
        out = pii.digests(df.withColumn("text", texts)).collect()
        assert len(out) == messy.count()
        none = hashlib.sha256(b"").hexdigest()
        by = {r["doc_id"]: r for r in out}
        assert (by[5]["n_email"], by[5]["n_card"], by[5]["spans"]) == (1, 1, "email:0:8,card:9:28")
        assert by[5]["base_sha256"] == hashlib.sha256(by[5]["spans"].encode()).hexdigest()
        assert all(r["base_sha256"] == none for r in out if r["doc_id"] in (60, 61, 62))
    assert pii.digests(empty).count() == 0 and pii.detect(empty).count() == 0
    red = {r["doc_id"]: r["redacted"] for r in pii.detect(messy.withColumn("text", texts)).collect()}
    assert red[5] == "[email] [card]" and red[60] is None
