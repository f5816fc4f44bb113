import random

import numpy as np
import pytest

from ashgrid.llm import decontamination as D
from tests.conftest import SF_SMALL
from tests.llm.helpers import no_docs, odd_docs, read, words

VOCABULARY = [f"w{i}" for i in range(2000)] + ["the", "of", "and", "to"] * 200


def slow_align(item, text):
    """Best local alignment score by the full recurrence."""
    score = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            score[i][j] = max(0, score[i - 1][j - 1] + (2 if a == b else -1),
                              score[i - 1][j] - 1, score[i][j - 1] - 1)
    return max(map(max, score))


def brute_force(docs, items, threshold=0.5):
    out = {}
    for i, text in docs:
        for k, item in items:
            a, b = words(item), words(text)
            if a and b:
                share = slow_align(a, b) / (2 * len(a))
                if share >= (threshold if len(a) >= 5 else 1):
                    out[i, k] = share
    return out


def sample(seed=0):
    rng = random.Random(seed)

    def prose(n):
        return [rng.choice(VOCABULARY) for _ in range(n)]

    items = [(k, " ".join(prose(rng.randrange(14, 40)))) for k in range(12)]
    docs = []
    for i in range(60):
        text = prose(rng.randrange(20, 150))
        if i % 2:
            copy = items[i % 12][1].split()
            if i % 4 == 1:                      # edited: words replaced, dropped and added
                for _ in range(len(copy) // 8):
                    copy[rng.randrange(len(copy))] = "edit"
                del copy[rng.randrange(len(copy))]
                copy.insert(rng.randrange(len(copy)), "more")
            at = rng.randrange(len(text))
            text[at:at] = copy
        docs.append((i, " ".join(text)))
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
            spark.createDataFrame(items, "item_id long, text string"))


def test_alignment_equals_the_recurrence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        item, text = (rng.integers(0, 5, rng.integers(1, 12)).astype(np.uint64) for _ in range(2))
        score, matched, start, end = D.align(item, text)
        assert score == slow_align(item.tolist(), text.tolist())
        assert matched <= end - start and (score == 0) == (matched == 0)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_equals_brute_force(spark, block_bytes):
    docs, items = sample()
    want = brute_force(docs, items)
    assert 25 <= len(want) <= 40
    got = D.contaminated(*frames(spark, docs, items), block_bytes=block_bytes).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.score) for r in got} == want
    assert len(got) == len(want)


def test_hit_names_its_words(spark):
    docs, items = sample()
    text = dict(docs)
    for r in D.contaminated(*frames(spark, docs, items)).where("score = 1").collect():
        assert words(text[r.doc_id])[r.start_word:r.end_word] == words(dict(items)[r.item_id])
        assert r.matched_words == r.end_word - r.start_word


def test_rows(spark):
    item = "quick brown fox jumps over the lazy dog"
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "the lazy dog"),
                                   (None, "word1 of a very long text word2 of a very long text")],
                                  "item_id long, text string")
    got = D.contaminated(odd_docs(spark), items).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in got) == \
        [(1, 1), (1, 1), (1, 4), (8, 0), (9, 1), (9, 1), (9, 4)]
    longer = D.contaminated(odd_docs(spark), items, min_words=4).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in longer) == \
        [(1, 1), (1, 1), (8, 0), (9, 1), (9, 1)]
    assert D.contaminated(no_docs(spark), items).count() == 0
    assert D.contaminated(odd_docs(spark), items.limit(0)).count() == 0
    kept = D.clean(odd_docs(spark), items)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 5, 6, 7, 10, 10]
    assert kept.columns == odd_docs(spark).columns


def test_query_finds_every_planted_passage(spark):
    ids, texts = read(SF_SMALL, "documents", "doc_id", "text")
    names, items = read(SF_SMALL, "benchmark", "item_id", "text")
    exact = {(i, k) for i, t in zip(ids, texts, strict=True)
             for k, item in zip(names, items, strict=True) if item in t}
    got = {(r.doc_id, r.item_id): r.score for r in D.op8_decontamination(spark, SF_SMALL).collect()}
    assert exact and exact <= set(got) and all(got[p] == 1.0 for p in exact)


@pytest.mark.parametrize("every", [3, 4, 5, 6])
def test_edits_at_every_few_words(spark, every):
    rng = random.Random(every)
    items = [(k, " ".join(rng.choice(VOCABULARY) for _ in range(n)))
             for k, n in enumerate((5, 9, 15, 24, 40))]
    docs = []
    for k, item in items:
        for how in ("replace", "insert", "drop", "mix"):
            copy = []
            for p, word in enumerate(item.split()):
                if (p + 1) % every:
                    copy.append(word)
                    continue
                does = rng.choice(("replace", "insert", "drop")) if how == "mix" else how
                copy += {"replace": ["edit"], "insert": ["more", word], "drop": []}[does]
            around = [rng.choice(VOCABULARY) for _ in range(30)]
            docs.append((len(docs), " ".join(around[:15] + copy + around[15:])))
            # an exact copy beside it made the seeds fall on the edited words
            docs.append((len(docs), item))
    want = brute_force(docs, items)
    assert len(want) >= 5 * 4 * 2 - 4
    got = D.contaminated(*frames(spark, docs, items)).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.score) for r in got} == want
    assert len(got) == len(want)


def passage(item, text):
    """Most words matched in a row, four taken off for every edit."""
    score = [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            score[i][j] = max(0, score[i - 1][j - 1] + (1 if a == b else -4),
                              score[i - 1][j] - 4, score[i][j - 1] - 4)
    return max(map(max, score))


@pytest.mark.parametrize("threshold", [0.1, 0.35, 0.5, 0.8, 0.95])
def test_every_threshold_equals_brute_force(threshold):
    rng = np.random.default_rng(11)
    found = 0
    for _ in range(150):
        item = rng.integers(0, 12, rng.integers(14, 20))
        rate = rng.choice((0.02, 0.2, 0.5))
        copy = [x for w in item for x in (([w, 99], [99], [])[rng.integers(3)]
                                          if rng.random() < rate else [w])]
        text = " ".join(f"v{x}" for x in [*rng.integers(0, 12, 12), *copy, *rng.integers(0, 12, 60)])
        item = " ".join(f"v{x}" for x in item)
        block = D.read_block([(0, item)], threshold)
        D.choose_seeds(block, rng.integers(0, 9, len(block.pairs)))
        (w,) = D.W.chunks(D.pa.array([text]))
        got = [share for _, _, share, *_ in D.find(w, block, threshold)]
        share = slow_align(words(item), words(text)) / (2 * len(words(item)))
        if share >= threshold:
            assert got == [share]
        elif passage(words(item), words(text)) >= 13:
            assert len(got) == 1 and got[0] < threshold
        else:
            assert not got
        found += bool(got)
    assert found


def test_share_alone_decides_on_short_items(spark):
    items = [(1, "one two three four five six seven eight"), (2, "red green blue black white")]
    docs = [(1, "so one two three four other six seven eight it is"), (2, "a red green blue car"),
            (3, "one two three of them"), (4, "red and blue")]
    got = D.contaminated(*frames(spark, docs, items)).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == {(1, 1): 13 / 16, (2, 2): 0.6}


def test_scripts_without_spaces(spark):
    items = [(1, "北京是中华人民共和国的首都"), (2, "東京タワーの高さは何メートルですか"),
             (3, "กรุงเทพมหานครเป็นเมืองหลวง"), (4, "𠀀𠀁𠀂𠀃𠀄")]
    docs = [(1, "我们知道北京是中华人民共和国的首都，很大。"), (2, "問題：東京タワーの高さは約何メートルですか？"),
            (3, "วันนี้กรุงเทพมหานครเป็นเมืองหลวงของไทย"), (4, "x𠀀𠀁𠀂𠀃𠀄y"),
            (5, "上海是一座很大的城市"), (6, "plain words only")]
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(*frames(spark, docs, items)).collect()}
    assert set(got) == {(k, k) for k in range(1, 5)}
    assert got[1, 1].score == got[3, 3].score == got[4, 4].score == 1.0
    assert (got[1, 1].start_word, got[1, 1].end_word) == (4, 17)


def test_long_passage_of_a_longer_item(spark):
    rng = random.Random(3)
    item = [f"q{i}" for i in range(59)]
    around = [rng.choice(VOCABULARY) for _ in range(40)]

    def doc(*middle):
        return " ".join([*around[:20], *middle, *around[20:]])

    docs = [(1, doc(*item[20:49])), (2, doc(*item[:13])), (3, doc(*item[:12])),
            (4, doc(*item[30:39], "edit", *item[40:48])), (5, doc(*item[30:38], "edit", *item[39:47])),
            (6, doc(*item[10:18], *around[:2], *item[30:38]))]
    got = D.contaminated(*frames(spark, docs, [(1, " ".join(item))])).collect()
    assert {r.doc_id: (r.score, r.matched_words, r.start_word, r.end_word) for r in got} == {
        1: (29 / 59, 29, 20, 49), 2: (13 / 59, 13, 20, 33), 4: (33 / 118, 17, 20, 38)}
    for k, text in docs:
        assert (passage(item, text.split()) >= 13) == (k in (1, 2, 4))


def test_clean_rows_of_a_null_or_repeated_id_stay(spark):
    item = "a passage that the benchmark asks about in these very words"
    rows = [(None, f"x {item} y"), (None, "clean text of no id"), (None, None),
            (7, item), (7, "clean text of the same id"), (8, "another clean text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = D.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (i or 0, t or "") for i, t in (rows[1], rows[2], rows[4], rows[5]))
