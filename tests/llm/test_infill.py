import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ashgrid.llm import infill as I
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ROWS, no_docs, odd_docs, read

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def brute(doc_id, text, rate=100, spm=50, seed=7):
    """(n, form, prefix chars, middle chars, output) by the definition."""
    text = text or ""
    units = LINES.findall(text)
    n = len(units)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def hard_rows():
    rng = random.Random(4)
    rows = [(i, "\n".join("x" * rng.randrange(40) for _ in range(rng.randrange(60)))) for i in range(40)]
    rows += [(100, "a line\n" * 30_000), (101, "one long line " * 20_000), (102, "ü漢😀\n" * 9_000 + "end"),
             (103, "has <P> a mark\nand more"), (104, "almost <\n" * 50 + "<S"), (105, "\n"), (106, "\n\n\n"),
             (107, "<" * 70_000 + "\n<M"), (108, "a\r\nb\x0bc d\n")]
    return rows


def test_query_equals_brute_force(spark):
    ids, texts = read(SF_ORACLE, "documents", "doc_id", "text")
    got = {r.doc_id: tuple(r)[1:] for r in I.op11_infill(spark, SF_ORACLE).collect()}
    for i, t in zip(ids, texts, strict=True):
        n, form, p, m, out = brute(i, t)
        assert got.pop(i) == (n, form, p, m, sha(out), sha(t or ""))
    assert not got


@pytest.mark.parametrize("piece", [7, 1 << 15])
def test_outputs_and_restored_texts(spark, monkeypatch, piece):
    monkeypatch.setattr(I, "PIECE", piece)
    rows = ROWS + hard_rows()
    if piece < 100:
        rows = [r for r in rows if len(r[1] or "") < 4000]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for options in ({}, {"rate": 40, "spm": 20, "seed": 11}):
        want = sorted(((i, *brute(i, t, **options), t or "") for i, t in rows), key=repr)
        out = sorted((tuple(r) for r in I.outputs(docs, **options).collect()), key=repr)
        assert out == sorted((w[:-1] for w in want), key=repr)
        got = sorted((tuple(r) for r in I.digests(docs, **options).collect()), key=repr)
        assert got == sorted(((*w[:5], sha(w[5]), sha(w[6])) for w in want), key=repr)


def test_restoring_reads_the_output_only():
    rng = random.Random(2)
    for _ in range(300):
        p, m, s = ("".join(rng.choice("<PSM>\nx") for _ in range(rng.randrange(12))) for _ in range(3))
        if any(x in p + m + s for x in ("<P>", "<S>", "<M>")):
            continue
        for form, out in (("psm", f"<P>{p}<S>{s}<M>{m}"), ("spm", f"<S>{s}<P>{p}<M>{m}")):
            data, pieces = out.encode(), []
            while data:
                k = rng.randrange(1, 6)
                pieces.append(data[:k])
                data = data[k:]
            back = ["", "", ""]
            for section, piece in I.sections(form, iter(pieces)):
                back[section] += piece.decode()
            assert back == [p, m, s]


def test_rows(spark):
    got = I.digests(odd_docs(spark)).collect()
    assert sorted((r.doc_id or 0, r.restored_sha256) for r in got) == sorted(
        (i or 0, sha(t or "")) for i, t in ROWS)
    assert I.digests(no_docs(spark)).count() == 0
    assert I.outputs(no_docs(spark)).count() == 0


def test_string_ids(spark):
    docs = spark.createDataFrame([("a", "x\ny\nz\n"), ("b", "x\ny\nz\n"), (None, "x")], "k string, t string")
    got = {r.k: r for r in I.outputs(docs, id_col="k", text_col="t").collect()}
    for k, t in (("a", "x\ny\nz\n"), ("b", "x\ny\nz\n"), (None, "x")):
        assert got[k].output == brute(k, t)[4]


def test_a_row_repeated_by_a_third_of_the_table_is_counted_not_copied(spark):
    docs = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("same\ntext\n" * 50)).otherwise(
            F.concat(F.lit("text\n"), F.col("id").cast("string"))).alias("text")).repartition(4)
    assert I.pieces(docs).where("id = -1").count() < 200
    got = I.digests(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got if r["count"] > 1} == {-1: 3000}
    assert len(got) == 6001
