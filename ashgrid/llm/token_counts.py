"""Token counts of a byte-level BPE vocabulary, by the whole-token shortcut.

A vocabulary string whose bytes merge into that one token is a whole token:
wherever the pre-tokenizer yields it, it counts one, whatever stands around
it, since merging never crosses a pre-token.  That is proved once per
vocabulary, by merging each of its strings.  Counting then looks pre-tokens
up, and merges only those that are no whole token (their counts are kept in
a bounded table).
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from .frames import kind, map_batches, table
from .texts import LETTERS, PLAIN, slices

#: The pre-tokenizer's pattern, and the bytes that a byte-level
#: vocabulary writes as the character of the same number.  All other bytes are
#: written, in order, as the characters from 256 on.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTED = ((33, 126), (161, 172), (174, 255))

#: Pre-tokens, and their characters, whose merged counts a worker keeps.
KEPT, KEPT_CHARS = 1_000_000, 32_000_000


def byte_letters() -> dict[str, int]:
    """The character for each byte in a byte-level vocabulary file."""
    plain = [b for lo, hi in PRINTED for b in range(lo, hi + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter(dict):
    """Pre-token -> number of tokens; unknown ones are merged on first use."""

    def __init__(self, path: str, proved: list[str] | None = None) -> None:
        """From a vocabulary file; ``proved`` are its whole tokens, if that is known."""
        super().__init__()
        self.held = 0
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if (model["type"], pre.get("type")) != ("BPE", "ByteLevel") or spec.get("normalizer") \
                or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError(f"{path}: only plain byte-level BPE vocabularies are supported")
        letters = byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in model["vocab"]
               if all(c in letters for c in t)}
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[raw[a], raw[b]] = rank
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = (regex.compile("|".join(regex.escape(s) for s in special))
                        if special else None)
        self.pieces = regex.compile(PATTERN)
        self.plain_pieces = re.compile(PATTERN.replace(r"\s\p{L}\p{N}", rf"\s{LETTERS}0-9")
                                       .replace(r"\p{L}", f"[{LETTERS}]")
                                       .replace(r"\p{N}", "[0-9]"))
        if proved is None:
            proved = []
            for token in raw.values():
                if self.merged(token) == 1:
                    try:
                        proved.append(token.decode())
                    except UnicodeDecodeError:
                        pass      # part of a character: never a pre-token of its own
        self.proved = dict.fromkeys(proved, 1)
        self.update(self.proved)

    def merged(self, piece: bytes) -> int:
        """Tokens left of ``piece`` after all merges, lowest rank first, leftmost first."""
        if len(piece) > 256:
            return self._merged_long(piece)
        rank_of, none = self.ranks.get, 1 << 30
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = [rank_of(pair, none) for pair in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = rank_of((parts[at], parts[at + 1]), none)
        return len(parts)

    def _merged_long(self, piece: bytes) -> int:
        """The same with a heap of pairs, for pre-tokens of any length."""
        n = len(piece)
        part: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < n:
                a, b = part[i], part[after[i]]
                rank = self.ranks.get((a, b))
                if rank is not None:
                    heapq.heappush(heap, (rank, i, a, b))

        for i in range(n):
            offer(i)
        count = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j >= n or part[j] != b:
                continue
            part[i], part[j] = a + b, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            count -= 1
            offer(before[i])
            offer(i)
        return count

    def __missing__(self, piece: str) -> int:
        if len(self) > len(self.proved) + KEPT or self.held > KEPT_CHARS:
            self.clear()
            self.update(self.proved)
            self.held = 0
        self.held += len(piece)
        count = self[piece] = self.merged(piece.encode())
        return count

    def count(self, text: str) -> int:
        """Tokens of a whole text; a special string inside it is one token."""
        split = (self.plain_pieces if PLAIN.fullmatch(text) else self.pieces).findall
        special = len(self.special.findall(text)) if self.special else 0
        if not special:
            return sum(map(self.__getitem__, split(text)))
        return special + sum(sum(map(self.__getitem__, split(part)))
                             for part in self.special.split(text))


_made: dict[str, Counter] = {}


def counter(path: str, proved: list[str] | None = None) -> Counter:
    """The counter of a vocabulary file, made once per process."""
    if path not in _made:
        _made[path] = Counter(path, proved)
    return _made[path]


def count_tokens(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row, over whole texts.

    ``vocabulary`` is the path of the tokenizer file on every machine; its
    whole tokens are proved here, once, before the job.  Null texts count as
    empty: no bytes, no tokens.  Repeated rows stay repeated; other columns are
    ignored; an empty table gives an empty one.
    """
    proved = docs.sparkSession.sparkContext.broadcast(       # strings of the vocabulary
        list(counter(vocabulary).proved))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        find = counter(vocabulary, proved.value)
        column = batch.column(1)
        tokens = np.zeros(len(column), np.int64)
        for lo, hi, texts in slices(column):
            tokens[lo:hi] = [find.count(t) for t in texts]
        size = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), size, pa.array(tokens), pa.array(tokens > limit)],
            names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind(docs, id_col)}, n_bytes long, n_tokens long, "
                       "over_limit boolean")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: tokens of all documents in the 50k byte-level vocabulary."""
    return count_tokens(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"))
