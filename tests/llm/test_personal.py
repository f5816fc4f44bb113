import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ashgrid.llm import personal as P
from tests.conftest import SF_SMALL
from tests.llm.helpers import ROWS, no_docs, odd_docs, read


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def base_spans(text):
    """The base patterns, searched over the whole text."""
    out = [(m.start(), k, name, m.end()) for k, (name, (pattern, good)) in enumerate(BASE.items())
           for m in re.finditer(pattern, text) if good(m)]
    return [(name, start, end) for start, _, name, end in sorted(out)]


def found(text):
    return [s for s in P.find(text) if s[0] in BASE]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+%_ 0123459()é:/", max_size=60))
def test_base_spans_equal_whole_text_search(text):
    assert found(text) == base_spans(text)


def test_chosen_texts():
    for text in ("a@b.c@d.e x@y..z a.b@c-d.e.f.", "1.2.3.4.5.6.7.8 300.1.1.1 0000.1.2.3",
                 "4111 1111 1111 1111, 4111-1111-1111-1112", "+49 (30) 123456-78 +1+2 ++49301234567",
                 "1" * 4000 + ".2.3.4", "@" * 50, "a" * 3000 + "@" + "b." * 500 + "c"):
        assert found(text) == base_spans(text)


def test_method_adds_spans():
    text = ("IBAN: DE89 3704 0044 0532 0130 00, http://user:pw@host.org/ account no: 12345678 "
            "iban GB00 1234 5678 9012 3456")
    extra = [(k, text[a:b]) for k, a, b in P.find(text) if k not in BASE]
    assert extra == [("iban", "DE89 3704 0044 0532 0130 00"), ("login", "user:pw"),
                     ("account", "12345678")]


def test_redaction():
    text = "mail x.y@z.org or +49 30 1234567, not 1.2.3"
    assert P.redact(text, P.find(text)) == "mail <EMAIL> or <PHONE>, not 1.2.3"
    assert P.redact("", []) == ""


def test_rows(spark):
    got = P.find_all(odd_docs(spark)).collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(i or 0 for i, _ in ROWS)
    assert P.find_all(no_docs(spark)).count() == 0
    docs = spark.createDataFrame([(1, "a@b.co", 6, "x"), (2, None, None, "y")],
                                 "doc_id long, text string, n_chars long, spans string")
    assert [tuple(r) for r in P.redact_all(docs).orderBy("doc_id").collect()] == [
        (1, "<EMAIL>", 7, "x"), (2, None, None, "y")]


def test_query_equals_patterns(spark):
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    got = {r.doc_id: r for r in P.op6_pii(spark, SF_SMALL).collect()}
    for i, t in zip(ids, texts, strict=True):
        spans = base_spans(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in spans) for k in BASE]
        assert set(joined.split(",")) <= set(got[i].spans.split(","))
