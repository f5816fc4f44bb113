"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Texts are cut into words: a run of spaces with the letters, or the other
signs, that follow it (no piece has a space after another sign, and the
vocabulary is checked for pieces that join letters and other signs).  New words of a batch are grouped by length
and advance together, one position at a time: hashes of all substrings probe
the sorted keys of the pieces of that length, and a vectorised maximum over
the pieces that end at a position stores its backpointer.

Two objectives share that search.  ``unigram`` maximises the sum of scores.
``bpe`` must give what repeated merging gives, which no sum of scores does:
there, a piece may end a prefix only if merging the last piece of the rest
of that prefix and the piece itself leaves these two pieces alone, and the
longest such piece is taken.  Merging depends on neighbours only, so a
sequence whose neighbours all stay apart is the merged one.  Whether a pair
stays apart is decided by merging its text, once per pair.  (Words that
begin with two or more spaces are merged directly, with a heap: their pieces
share one score, which that argument doesn't cover.)  Characters without a
piece become the pieces of their bytes.

A text without breaks is one word, which has nothing to advance together
with: its substrings are probed all at once like any other's, and its
positions are then walked one by one over the pieces that were found.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from .frames import kind, map_batches, table
from .texts import LETTERS, PLAIN, slices
from .words import _P, _P_INVERSE, mix

SPACE = "▁"
#: Words, their characters, and pairs of pieces, whose results a worker keeps.
KEPT, KEPT_CHARS = 250_000, 16_000_000
#: Characters from where a word is walked alone.
LONG = 512
_JOINED = regex.compile(rf"[\p{{L}}\p{{M}}][^{SPACE}\p{{L}}\p{{M}}]|[^{SPACE}\p{{L}}\p{{M}}][\p{{L}}\p{{M}}]")
_PROBE = "  a bÄﬁ c\n"


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2^64."""
    made = []
    for base in (_P, _P_INVERSE):
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        made.append(np.multiply.accumulate(factors))
    return made[0], made[1]


class Codec:
    """Pieces of a model file with search structures, made once per worker."""

    def __init__(self, path: str, objective: str) -> None:
        if objective not in ("bpe", "unigram"):
            raise ValueError(f"objective {objective!r} is not bpe or unigram")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize(_PROBE) != SPACE + _PROBE.replace(" ", SPACE):
            raise ValueError(f"{path}: only models that keep texts and add one space in front "
                             "are supported")
        self.objective = objective
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.plain_score = [model.get_score(i) for i in range(n)]
        self.score = np.array(self.plain_score)
        self.bytes_id = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        if len(self.bytes_id) != 256:
            raise ValueError(f"{path}: only models with byte pieces are supported")
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i)
                                             or model.is_unknown(i) or model.is_unused(i))]
        self.id = {names[i]: i for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError(f"{path}: a piece has a space after another sign")
        # where no piece joins a letter and another sign, words end there too
        self.words = regex.compile(
            rf"{SPACE}*[^{SPACE}]+|{SPACE}+" if any(_JOINED.search(p) for p in self.id) else
            rf"{SPACE}*[\p{{L}}\p{{M}}]+|{SPACE}*[^{SPACE}\p{{L}}\p{{M}}]+|{SPACE}+")
        self.plain_words = re.compile(self.words.pattern.replace(r"\p{L}\p{M}", LETTERS))
        self.size = n
        self.longest = max(map(len, self.id))
        self.out = [b""] * n
        for i in plain:
            self.out[i] = names[i].replace(SPACE, " ").encode()
        for value, i in self.bytes_id.items():
            self.out[i] = bytes([value])
        self.out_size = np.array([len(b) for b in self.out])
        self.out_first = np.cumsum(self.out_size) - self.out_size
        self.out_data = np.frombuffer(b"".join(self.out), np.uint8)
        self.names = names
        self.pairs, self.apart = np.array([-1]), np.array([True])
        self.known_pairs: dict[tuple[int, int], bool] = {}
        self._index()
        self._forget()

    def _index(self) -> None:
        """Sorted hashes of the usable pieces of each length."""
        self.power, self.inverse = _powers_to(1 << 12)
        by_length: dict[int, list[str]] = {}
        for piece in self.id:
            if self.objective == "unigram" or len(piece) == 1 or self.merge(piece) == [piece]:
                by_length.setdefault(len(piece), []).append(piece)
        self.keys: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length, pieces in by_length.items():
            points = np.array([[ord(c) for c in p] for p in pieces], np.uint64)
            keys = self._prefix(points)[:, -1]
            order = np.argsort(keys)
            self.keys[length] = (keys[order], np.array([self.id[p] for p in pieces])[order])

    def _forget(self) -> None:
        self.held = 0
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n <= len(self.power):
            return self.power[:n], self.inverse[:n]
        return _powers_to(n)

    def _prefix(self, points: np.ndarray) -> np.ndarray:
        """Prefix hashes of rows of code points, a leading zero first."""
        power, _ = self._powers(points.shape[1])
        out = np.zeros((len(points), points.shape[1] + 1), np.uint64)
        np.cumsum(mix(points) * power, axis=1, out=out[:, 1:])
        return out

    def merge(self, word: str) -> list[str]:
        """Pieces left after merging the best-scored neighbours, leftmost first."""
        if len(word) > 64:
            return self._merge_long(word)
        parts = list(word)
        none = -np.inf

        def score(i: int) -> float:
            joined = self.id.get(parts[i] + parts[i + 1])
            return none if joined is None else self.plain_score[joined]

        scores = [score(i) for i in range(len(parts) - 1)]
        while scores:
            best = max(scores)
            if best == none:
                break
            at = scores.index(best)
            parts[at] += parts.pop(at + 1)
            del scores[at]
            if at:
                scores[at - 1] = score(at - 1)
            if at < len(scores):
                scores[at] = score(at)
        return parts

    def _merge_long(self, word: str) -> list[str]:
        """The same with a heap of pairs, for words of any length."""
        n = len(word)
        part: list[str | None] = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                a, b = part[i], part[after[i]]
                joined = self.id.get(a + b)
                if joined is not None:
                    heapq.heappush(heap, (-self.plain_score[joined], i, a, b))

        for i in range(n):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue                       # one of them was merged since
            part[i], part[j] = a + b, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in part if p is not None]

    def _spelled(self, pieces: list[str]) -> list[int]:
        """Ids of pieces; a character without one becomes its bytes."""
        out: list[int] = []
        for p in pieces:
            i = self.id.get(p)
            out += [i] if i is not None else [self.bytes_id[b] for b in p.encode()]
        return out

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For pairs of piece ids (-1: start of word or a sign without a piece)."""
        pair = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        new = np.unique(pair[(self.pairs[at] != pair) & (left >= 0)])
        if len(new):
            if len(self.pairs) > 4 * KEPT:
                self.pairs, self.apart = np.array([-1]), np.array([True])
            value = np.empty(len(new), dtype=bool)
            for i, p in enumerate(new.tolist()):
                a, b = self.names[p // self.size], self.names[p % self.size]
                value[i] = self.merge(a + b) == [a, b]
            where = np.searchsorted(self.pairs, new)
            self.pairs = np.insert(self.pairs, where, new)
            self.apart = np.insert(self.apart, where, value)
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return (left < 0) | (self.apart[at] & (self.pairs[at] == pair))

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per word) of words of one length, which advance together."""
        m, length = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32
                               ).astype(np.uint64).reshape(m, length)
        prefix = self._prefix(points)
        _, inverse = self._powers(length + 1)
        match = {}
        for size, (keys, ids) in self.keys.items():
            if size <= length:
                probe = (prefix[:, size:] - prefix[:, :-size]) * inverse[:length - size + 1]
                at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
                match[size] = np.where(keys[at] == probe, ids[at], -1)
        if length > LONG:
            ids = [self._walk_one(word, {size: found[i] for size, found in match.items()})
                   for i, word in enumerate(words)]
            return np.concatenate(ids), np.array([len(i) for i in ids], np.int64)
        sizes = sorted(match, reverse=True)      # longest first
        step = np.zeros((m, length + 1), np.int32)          # backpointer: length of last piece
        last = np.full((m, length + 1), -1, np.int64)       # last piece, -1 for none
        total = np.zeros((m, length + 1))
        unknown = self.score.min() - 10.0
        for end in range(1, length + 1):
            best = np.full(m, -np.inf)
            for size in sizes:
                if size > end:
                    continue
                piece = match[size][:, end - size]
                rows = np.flatnonzero(piece >= 0)
                if self.objective == "bpe":
                    rows = rows[best[rows] < size]
                    if len(rows):
                        rows = rows[self._stay_apart(last[rows, end - size], piece[rows])]
                    value = np.full(len(rows), float(size))
                else:
                    value = total[rows, end - size] + self.score[piece[rows]]
                    rows, value = rows[value > best[rows]], value[value > best[rows]]
                best[rows], step[rows, end], last[rows, end] = value, size, piece[rows]
            # a sign without a piece stands alone
            single = match[1][:, end - 1] if 1 in match else np.full(m, -1)
            none = (single < 0) & (best == -np.inf)
            if self.objective == "unigram":
                none = (single < 0) & (total[:, end - 1] + unknown > best)
                best[none] = total[none, end - 1] + unknown
            step[none, end], last[none, end] = 1, -1
            total[:, end] = np.where(np.isfinite(best), best, 0.0)
        return self._walk(words, step, last)

    def _walk_one(self, word: str, match: dict[int, np.ndarray]) -> np.ndarray:
        """Ids of one word, whose pieces of each size are known by their start."""
        length, bpe = len(word), self.objective == "bpe"
        sizes = np.array(sorted(match, reverse=True), np.int64)
        found = [(size, np.flatnonzero(match[size] >= 0)) for size in sizes.tolist()]
        end = np.concatenate([at + size for size, at in found])
        size_of = np.concatenate([np.full(len(at), size) for size, at in found])
        piece_of = np.concatenate([match[size][at] for size, at in found])
        order = np.lexsort((-size_of, end))                 # by end, longest first
        cut = np.searchsorted(end[order], np.arange(length + 2)).tolist()
        size_of, piece_of = size_of[order].tolist(), piece_of[order].tolist()
        score, lowest = self.plain_score, float(self.score.min()) - 10.0
        step, last, total = [0] * (length + 1), [-1] * (length + 1), [0.0] * (length + 1)
        for at in range(1, length + 1):
            best = -np.inf
            single = False
            for k in range(cut[at], cut[at + 1]):
                size, piece = size_of[k], piece_of[k]
                single = single or size == 1
                if bpe:
                    if best == -np.inf and self._apart(last[at - size], piece):
                        best, step[at], last[at] = float(size), size, piece
                else:
                    value = total[at - size] + score[piece]
                    if value > best:
                        best, step[at], last[at] = value, size, piece
            if not single and (best == -np.inf if bpe else total[at - 1] + lowest > best):
                best = -np.inf if bpe else total[at - 1] + lowest
                step[at], last[at] = 1, -1
            total[at] = best if np.isfinite(best) else 0.0
        pieces, at = [], length
        while at > 0 and step[at]:
            pieces.append(word[at - step[at]:at])
            at -= step[at]
        return np.array(self._spelled(pieces[::-1] if at == 0 else self.merge(word)), np.int32)

    def _apart(self, left: int, right: int) -> bool:
        """One pair of piece ids; ``_stay_apart`` is the same for many."""
        if left < 0:
            return True
        kept = self.known_pairs.get((left, right))
        if kept is None:
            if len(self.known_pairs) > 4 * KEPT:
                self.known_pairs.clear()
            a, b = self.names[left], self.names[right]
            kept = self.known_pairs[left, right] = self.merge(a + b) == [a, b]
        return kept

    def _walk(self, words: list[str], step: np.ndarray, last: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, ids per word), following the backpointers."""
        m, length = len(words), len(words[0])
        rows, end = np.arange(m), np.full(m, length)
        back = np.full((m, length), -2, np.int64)
        for k in range(length):
            live = (end > 0) & (step[rows, end] > 0)
            if not live.any():
                break
            back[live, length - 1 - k] = last[rows[live], end[live]]
            end = np.where(live, end - step[rows, end], end)
        # words that hold signs without a piece, or found no way, are spelled one by one
        odd = np.flatnonzero((end > 0) | (back == -1).any(axis=1))
        counts = (back >= 0).sum(axis=1)
        if not len(odd):
            return back[back >= 0].astype(np.int32), counts
        spelled = {}
        for i in odd.tolist():
            pieces: list[str] = []
            at = length
            while at > 0 and step[i, at]:
                pieces.append(words[i][at - step[i, at]:at])
                at -= step[i, at]
            spelled[i] = self._spelled(pieces[::-1] if at == 0 else self.merge(words[i]))
            counts[i] = len(spelled[i])
        parts = [np.array(spelled[i], np.int32) if i in spelled
                 else back[i][back[i] >= 0].astype(np.int32) for i in range(m)]
        return np.concatenate(parts), counts

    def _learn(self, words: list[str]) -> None:
        """Encode new words and keep the results."""
        by_length: dict[int, list[str]] = {}
        ids, counts, order = [self.flat], [], []
        for word in words:
            if self.objective == "bpe" and word[:2] == SPACE * 2:
                spelled = self._spelled(self.merge(word))
                ids.append(np.array(spelled, np.int32))
                counts.append([len(spelled)])
                order.append(word)
            else:
                by_length.setdefault(len(word), []).append(word)
        for length, group in by_length.items():
            step = max(1, (1 << 18) // (length * 8))      # bounded memory for any length
            for lo in range(0, len(group), step):
                part = group[lo:lo + step]
                found, sizes = self.search(part)
                ids.append(found)
                counts.append(sizes)
                order += part
        self.held += sum(map(len, order))
        self.place.update(zip(order, range(len(self.place), len(self.place) + len(order)),
                              strict=True))
        self.flat = np.concatenate(ids)
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(np.concatenate(counts))))

    def _split(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return (self.plain_words if PLAIN.fullmatch(text) else self.words).findall(marked)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, first id of each text and one more)."""
        split = [self._split(t) for t in texts]
        if len(self.place) > KEPT or self.held > KEPT_CHARS:
            self._forget()
        new = sorted(set(chain.from_iterable(split)) - self.place.keys())
        if new:
            self._learn(new)
        counts = np.array([len(ws) for ws in split], np.int64)
        word = np.fromiter(map(self.place.__getitem__, chain.from_iterable(split)), np.int64,
                           counts.sum())
        lo, size = self.first[word], self.first[word + 1] - self.first[word]
        offsets = np.concatenate(([0], np.cumsum(size)))
        index = np.arange(offsets[-1]) + np.repeat(lo - offsets[:-1], size)
        return self.flat[index], offsets[np.concatenate(([0], np.cumsum(counts)))]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """Texts of runs of ids; the one space in front goes, bad bytes become U+FFFD."""
        size = self.out_size[ids]
        offsets = np.concatenate(([0], np.cumsum(size)))
        index = np.arange(offsets[-1]) + np.repeat(self.out_first[ids] - offsets[:-1], size)
        data = self.out_data[index].tobytes()
        cut = offsets[first]
        texts = (data[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:], strict=False))
        return [t[1:] if t.startswith(" ") else t for t in texts]


@lru_cache(maxsize=4)
def codec(path: str, objective: str) -> Codec:
    """The codec of a model file, made once per worker."""
    return Codec(path, objective)


def encode(docs: DataFrame, model: str, *, objective: str = "bpe", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_pieces, ids, round_trip) of every row, over whole texts.

    ``round_trip`` says whether decoding gives the text back (a text that holds
    U+2581 itself comes back with spaces there).  Null and empty texts have no
    pieces.  Repeated rows stay repeated; other columns are ignored; an empty
    table gives an empty one.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        use = codec(model, objective)
        for lo, hi, texts in slices(batch.column(1), 1 << 21):
            ids, first = use.encode(texts)
            same = [a == b for a, b in zip(texts, use.decode(ids, first), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[lo:hi], pa.array(np.diff(first), pa.int64()),
                 pa.ListArray.from_arrays(first.astype(np.int32), pa.array(ids, pa.int32())),
                 pa.array(same)],
                names=[id_col, "n_pieces", "ids", "round_trip"])

    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind(docs, id_col)}, n_pieces long, ids array<int>, "
                       "round_trip boolean")


def decode(encoded: DataFrame, model: str, *, objective: str = "bpe", id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """(id, text) of every row of piece ids; a null array is an empty text."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        use = codec(model, objective)
        lists = pc.fill_null(batch.column(1).cast(pa.list_(pa.int32())), pa.scalar([], pa.list_(pa.int32())))
        flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False)
        first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(use.decode(flat, first), pa.string())],
            names=[id_col, "text"])

    return map_batches(encoded.select(id_col, ids_col), run,
                       f"`{id_col}` {kind(encoded, id_col)}, text string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: all documents as piece ids of the 32k model, with the round trip."""
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
