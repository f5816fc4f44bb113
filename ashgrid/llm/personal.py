"""Personal data: anchors found by Aho-Corasick, grown by local parsers.

One automaton pass over a text finds at-signs, plus signs, digits, schemes
and identifier cue words.  At each anchor a deterministic parser reads the
characters around it: the local part left of an at-sign and the labels right
of it, four dotted numbers, digit groups, international numbers, user
information in an address, an IBAN or account number after its cue.  Each
result is validated (label structure, parts up to 255, Luhn, digit counts,
IBAN check digits).  Within one kind matches never overlap: a parser starts
only after the end of the kind's last match, kept or dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import kind, map_batches, table
from .texts import slices

#: Kinds in their order; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "login", "iban", "account")
BASE = 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_RUN = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOGIN = re.compile(r"://([^\s/@:?#]+):([^\s/@?#]+)@")
_IBAN = re.compile(r"\W{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"(?:\x20?(?:no|nr|number|id|#)\.?)?[\x20:=#]{1,3}([A-Z]{0,3}[0-9][0-9-]{4,}[0-9])",
                      re.IGNORECASE | re.ASCII)
#: Cue words of the account parser; the automaton also gets them capitalised.
_CUES = ("account", "acct", "konto", "compte", "cuenta", "passport", "ssn")


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for word, parser in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(word, (parser, len(word)))
    for cue in _CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            found.add_word(form, ("account", len(form)))
    for form in ("iban", "Iban", "IBAN"):
        found.add_word(form, ("iban", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def iban_valid(text: str) -> bool:
    """Whether the number's remainder modulo 97 is one."""
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then kind as listed."""
    spans: list[tuple[int, int, int]] = []
    ends = [0] * len(KINDS)          # where each kind may start again
    run_end = 0
    for last, (parser, length) in _anchors().iter(text):
        at = last - length + 1
        if parser == "digit":
            if at >= ends[2]:
                m = _CARD.match(text, at)
                if m:
                    ends[2] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append((at, 2, m.end()))
            if at >= ends[1] and at >= run_end:
                m = _IP.match(text, at)
                if m:
                    ends[1] = m.end()
                    if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255
                           for part in m[0].split(".")):
                        spans.append((at, 1, m.end()))
                else:
                    run_end = _RUN.match(text, at).end()
        elif parser == "at":
            start = at
            while start > ends[0] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at)):
                spans.append((start, 0, m.end()))
                ends[0] = m.end()
        elif parser == "plus":
            if at >= ends[3] and (m := _PHONE.match(text, at)):
                ends[3] = m.end()
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    spans.append((at, 3, m.end()))
        elif parser == "scheme":
            if at >= ends[4] and (m := _LOGIN.match(text, at)):
                ends[4] = m.end()
                spans.append((m.start(1), 4, m.end(2)))
        elif parser == "iban":
            if at >= ends[5] and (m := _IBAN.match(text, last + 1)):
                span = _iban_span(text, m.start(1), m.end(1))
                if span:
                    ends[5] = span
                    spans.append((m.start(1), 5, span))
        elif at >= ends[6] and (m := _ACCOUNT.match(text, last + 1)):
            ends[6] = m.end()
            spans.append((m.start(1), 6, m.end(1)))
    return [(KINDS[k], start, end) for start, k, end in sorted(spans)]


def _iban_span(text: str, start: int, end: int) -> int | None:
    """End of the longest valid IBAN that begins at ``start``."""
    compact = ""
    valid = None
    for i in range(start, end):
        if text[i] != " ":
            compact += text[i]
            if len(compact) >= 15 and iban_valid(compact):
                valid = i + 1
    return valid


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, overlapping ones as one, replaced by its first kind's name."""
    out, done = [], 0
    i = 0
    while i < len(spans):
        name, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"<{name.upper()}>"]
        done = end
    return "".join(out) + text[done:]


def find_all(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: an array of (kind, start, end), over whole texts.

    Null and empty texts have no spans; repeated rows stay repeated; other
    columns are ignored; an empty table gives an empty one.
    """
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, texts in slices(batch.column(1)):
            found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t)]
                     for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[lo:hi], pa.array(found, pa.list_(item))],
                names=[id_col, "spans"])

    return map_batches(docs.select(id_col, text_col), run, f"`{id_col}` {kind(docs, id_col)}, "
                       "spans array<struct<kind:string,start:int,end:int>>")


def redact_all(docs: DataFrame, *, text_col: str = "text", n_chars_col: str | None = "n_chars"
               ) -> DataFrame:
    """All rows and columns, with personal data replaced in the text (null stays null).

    The count of code points, if there is one, follows the new text.
    """
    names = docs.columns
    where = names.index(text_col)
    schema = ", ".join(f"`{c}` {kind(docs, c)}" for c in names)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, texts in slices(batch.column(where)):
            part = batch.slice(lo, hi - lo)
            known = part.column(where).is_valid().to_pylist()
            new = [redact(t, find(t)) if k else None for t, k in zip(texts, known, strict=True)]
            columns = list(part.columns)
            columns[where] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = map_batches(docs, run, schema)
    if n_chars_col in names:
        out = out.withColumn(n_chars_col, F.char_length(text_col).cast(kind(docs, n_chars_col)))
    return out


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: personal data of all documents, with the digest of the base spans."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(name: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:BASE]))
    return find_all(table(spark, sf_dir, "documents")).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:BASE]),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
