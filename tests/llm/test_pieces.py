import random
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ashgrid.llm import pieces as S
from tests.conftest import SF_SMALL
from tests.llm.helpers import LONG, ROWS, no_docs, odd_docs, read

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(texts, objective="bpe"):
    ids, first = S.codec(PATH, objective).encode(texts)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


TEXTS = ["", " ", "   ", "a", "  two  spaces ", "tab\tline\n\nend", "漢字かな 😀​", "éﬁ½²",
         "don't stop: (now); x==y", "a" * 200, "abc" * 90, "▁literal ▁", "x\u0000y", LONG[:5000],
         "      def f(x):\n            return x"]


def test_ids_equal_the_library():
    assert encoded(TEXTS) == LIBRARY.encode(TEXTS)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text_encodes_as_in_the_library(texts):
    assert encoded(texts) == LIBRARY.encode(texts)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(exclude_characters="▁", exclude_categories=["Cs"]), max_size=60))
def test_round_trip(text):
    use = S.codec(PATH, "bpe")
    ids, first = use.encode([text, text])
    assert use.decode(ids, first) == [text, text]


def test_unigram_objective_reaches_the_best_score():
    use = S.codec(PATH, "unigram")
    unknown = use.score.min() - 10.0
    for word in ("▁hello", "▁internationally", "thereafter", "▁ñandú", "zzzzqqqq"):
        best = [0.0] + [-np.inf] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                piece = word[start:end]
                if piece in use.id:
                    best[end] = max(best[end], best[start] + use.score[use.id[piece]])
                elif len(piece) == 1:
                    best[end] = max(best[end], best[start] + unknown)
        ids, counts = use.search([word])
        got = sum(use.score[i] for i in ids)
        assert counts.tolist() == [len(ids)] and got == pytest.approx(best[-1])


def test_bounded_tables_forget_and_stay_right(monkeypatch):
    monkeypatch.setattr(S, "KEPT", 3)
    use = S.Codec(PATH, "bpe")
    for texts in (TEXTS[:6], TEXTS[6:], TEXTS[:6]):
        ids, first = use.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == \
            LIBRARY.encode(texts)


def test_rows_and_decoding(spark):
    made = S.encode(odd_docs(spark), PATH)
    got = made.collect()
    assert sorted((r.doc_id or 0, r.ids, r.round_trip) for r in got) == sorted(
        (i or 0, LIBRARY.encode(t or ""), True) for i, t in ROWS)
    back = S.decode(made, PATH).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in ROWS)
    assert S.encode(no_docs(spark), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in S.decode(nothing, PATH).collect()] == ["", ""]


def test_query_equals_library(spark):
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    got = {r.doc_id: (r.ids, r.round_trip, r.n_pieces)
           for r in S.op2_sentencepiece(spark, SF_SMALL).collect()}
    want = LIBRARY.encode(texts)
    assert got == {i: (w, True, len(w)) for i, w in zip(ids, want, strict=True)}


def long_texts():
    rng = random.Random(1)
    han = [chr(c) for c in range(0x4E00, 0x5200)]
    return [" " * 3000, "a" + " " * 2999 + "b", "".join(rng.choice(han) for _ in range(3000)),
            "".join(rng.choice("abcdefghij") for _ in range(3000)), "=" * 3000, "ab" * 1500, "漢" * 2000,
            "".join(rng.choice("aé漢😀1=") for _ in range(3000)), "internationally" * 200,
            "x" * S.LONG, "y" * (S.LONG - 1), "z" * (S.LONG + 1)]


def test_unbroken_texts_equal_the_library():
    texts = long_texts()
    for text in texts:
        assert encoded([text]) == LIBRARY.encode([text])
    assert encoded(texts + texts[:3]) == LIBRARY.encode(texts + texts[:3])


def test_walking_alone_equals_advancing_together(monkeypatch):
    words = [t.replace(" ", S.SPACE)[:300] for t in long_texts()]
    for objective in ("bpe", "unigram"):
        use = S.codec(PATH, objective)
        together = [use.search([w])[0].tolist() for w in words]
        monkeypatch.setattr(S, "LONG", 0)
        assert [use.search([w])[0].tolist() for w in words] == together
        monkeypatch.undo()


def test_a_megabyte_without_breaks_takes_seconds():
    rng = random.Random(2)
    for text in (" " * (1 << 20), "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(350_000))):
        start = time.perf_counter()
        ids = encoded([text])[0]
        assert time.perf_counter() - start < 30
        assert ids == LIBRARY.encode(text)


def test_kept_words_are_bounded_by_their_characters(monkeypatch):
    monkeypatch.setattr(S, "KEPT_CHARS", 2000)
    use = S.Codec(PATH, "bpe")
    for i in range(40):
        text = f"word{i} " * 3 + "x" * 100 + str(i)
        ids, _ = use.encode([text])
        assert ids.tolist() == LIBRARY.encode(text)
        assert use.held <= 2000 + 200
