"""Secret scans: novelty against a primed zstandard dictionary.

Three base patterns find assignments, access keys and long hexadecimal runs.
Beyond them, every long unbroken string shortly after a sensitive word is a
candidate.  Its novelty is the marginal size of its compressed form: the
bytes that a zstandard frame grows by when the candidate follows the code
around it, with a dictionary of identifiers primed, divided by its length.
Words and identifiers cost little; keys are incompressible.

The dictionary holds the parts of the identifiers that stand around sensitive
words in many different rows, counted over all of them, after a fixed list.
A text is searched in one pass, however many sensitive words it holds.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import kind, map_batches, table
from .texts import slices

#: Kinds in their order; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "novel")
BASE = 3

#: Least share of its length that a candidate adds to the compressed context:
#: of letters and digits together, and of one of them alone, as words and numbers are.
NOVELTY, NOVELTY_ALIKE = 0.6, 0.72
#: Code points of surrounding text that prime the measure, on each side.
AROUND = 256
#: A candidate starts within so many code points after a sensitive word; long
#: strings that stand between are not counted.
REACH = 32
#: Parts of identifiers in the counted dictionary at most, and in how many
#: different rows each must stand.
PARTS, LEAST_ROWS = 4096, 5

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_SENSITIVE = re.compile(r"(?i:passw|passphrase|secret|token|api.?key|credential|private.?key|"
                        r"bearer|authorization|access.?key|client.?id|signature)", re.ASCII)
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Words and identifiers that code and settings repeat.
IDENTIFIERS = """
abstract access account address application argument array assert async authentication
authorization await backend base64 boolean branch bucket buffer build bytes cache callback
certificate channel class client client_id client_secret cluster column command commit
component config configuration connection constant container content context controller
cookie count create credential credentials current cursor database dataset datetime debug
default delete dependency deploy description destination development dictionary directory
document domain double element enable encoding encrypt endpoint entry environment error
event example exception execute export extends factory false field file filename filter
final float folder format function gateway generate global group handler hash header
helper host hostname identifier implements import index information initialize input
instance integer interface internal iterator kernel key keyword label language length
library license list listener local localhost location logger login manager mapping master
message metadata method model module network notification null number object operation
option organization output package parameter parent parser passphrase password path
pattern permission pipeline plugin pointer policy port postgres prefix private process
production profile project property protected protocol provider proxy public python query
queue random reader record reference register registry release remote repository request
resource response result return revision role route runtime sample schema scope script
secret section security select sequence serializer server service session setting
settings signature size socket source staging state static status storage stream string
struct subject subscription system table target template tenant test thread timeout
timestamp title token transaction transport true type undefined unique update upload url
user username utils validate value variable vector version virtual volume warning webhook
widget window worker workspace wrapper writer xxxxxxxxxxxxxxxx 0000000000000000
0123456789abcdef abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 1234567890
your_api_key_here changeme placeholder example_token dummy_password https:// http:// www. .com
"""


_PART = re.compile(r"[A-Za-z][a-z]{3,14}(?![a-z])|[A-Z]{4,15}(?![A-Za-z])")


@lru_cache(maxsize=4)
def _compressor(parts: tuple[str, ...] = ()) -> zstandard.ZstdCompressor:
    # what stands last in a dictionary is nearest: the fixed list
    primed = zstandard.ZstdCompressionDict(
        " ".join([*reversed(parts), *IDENTIFIERS.split()]).encode(),
        dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=9)
    return zstandard.ZstdCompressor(dict_data=primed, write_checksum=False,
                                    write_content_size=False, write_dict_id=False)


def novelty(text: str, start: int, end: int, parts: tuple[str, ...] = ()) -> float:
    """Marginal compressed bytes of ``text[start:end]`` per byte of it (0 for nothing)."""
    if end <= start:
        return 0.0
    squeeze = _compressor(parts).compress
    around = text[max(0, start - AROUND):start] + "\n" + text[end:end + AROUND] + "\n"
    candidate = text[start:end].encode()
    known = around.encode()
    return max(0.0, (len(squeeze(known + candidate)) - len(squeeze(known))) / len(candidate))


def candidates(text: str) -> list[tuple[int, int]]:
    """Long strings in reach of a sensitive word, in order.

    A string of 16 or more is in reach if at most ``REACH`` code points lie
    between the end of such a word and its start, other long strings not
    counted.  A string that holds such a word is one from the end of the first,
    if 16 or more are left.  Words and strings are merged in one pass.
    """
    cues = [m.end() for m in _SENSITIVE.finditer(text)]
    found: list[tuple[int, int]] = []
    if not cues:
        return found
    limit, at = -1, 0                    # the furthest start in reach, the next cue
    for m in _STRING.finditer(text):
        start, end = m.span()
        while at < len(cues) and cues[at] <= start:
            limit = max(limit, cues[at] + REACH)
            at += 1
        if at < len(cues) and cues[at] + 16 <= end:
            found.append((cues[at], end))
        elif start <= limit:
            found.append((start, end))
        if start <= limit:
            limit += end - start
        while at < len(cues) and cues[at] <= end:
            limit = max(limit, end + REACH)
            at += 1
    return found


def find(text: str, parts: tuple[str, ...] = ()) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, novelty) in code points, by start, then kind as listed.

    A candidate that overlaps no base span is a ``novel`` span if its novelty
    says so; ``parts`` extend the dictionary.
    """
    spans: list[tuple[int, int, int, float]] = []
    if "=" in text or ":" in text:
        for m in _ASSIGN.finditer(text):
            if len(m[1]) >= 12:
                spans.append((m.start(), 0, m.end(), novelty(text, m.start(1), m.end(1), parts)))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= 18:
                spans.append((m.start(), 1, m.end(), novelty(text, *m.span(), parts)))
    for m in _HEX.finditer(text):
        spans.append((m.start(), 2, m.end(), novelty(text, *m.span(), parts)))
    # ends of the base spans that start at or before each, the furthest
    spans.sort()
    starts, reach = [s[0] for s in spans], []
    for s in spans:
        reach.append(max(s[2], reach[-1] if reach else 0))
    for start, end in candidates(text):
        before = bisect_left(starts, end)
        if before and reach[before - 1] > start:
            continue
        value = novelty(text, start, end, parts)
        if value >= (NOVELTY if _mixed(text[start:end]) else NOVELTY_ALIKE):
            spans.append((start, 3, end, value))
    return [(KINDS[k], start, end, value) for start, k, end, value in sorted(spans)]


def _mixed(candidate: str) -> bool:
    """Digits together with letters: what a word in any language is not."""
    return any(c.isdigit() for c in candidate) and any(c.isalpha() for c in candidate)


def surroundings(text: str) -> set[str]:
    """Parts of the identifiers that stand around the sensitive words of a text.

    A part is a run of 4 to 15 letters without a capital inside, so no piece of
    a random string is likely one.
    """
    parts: set[str] = set()
    done = 0
    for m in _SENSITIVE.finditer(text):
        if m.end() + AROUND > done:
            lo = max(done, m.start() - AROUND)
            done = m.end() + AROUND
            parts.update(_PART.findall(text, lo, done))
    return parts


def dictionary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
               ) -> tuple[str, ...]:
    """The most common identifier parts around sensitive words, over all rows.

    Counted are different texts (copies of one count once); parts in fewer than
    ``LEAST_ROWS`` of them are left out, ties go by the part itself, and at
    most ``PARTS`` come to the driver.
    """
    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, texts in slices(batch.column(1)):
            found = [sorted(surroundings(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[lo:hi], pa.array(found, pa.list_(pa.string()))],
                names=["text_key", "parts"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    made = map_batches(docs.select(F.xxhash64(text).alias("text_key"), text.alias("text")), make,
                       "text_key long, parts array<string>")
    counted = (made.where(F.size("parts") > 0).groupBy("text_key").agg(F.first("parts").alias("parts"))
               .select(F.explode("parts").alias("part")).groupBy("part").agg(F.count("*").alias("n"))
               .where(F.col("n") >= LEAST_ROWS).orderBy(F.desc("n"), "part").limit(PARTS))
    return tuple(r.part for r in counted.collect())


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: an array of (kind, start, end, novelty), over whole texts.

    The dictionary is counted over the same rows first.  Null and empty texts have no spans; repeated rows stay repeated; other
    columns are ignored; an empty table gives an empty one.
    """
    names = ("kind", "start", "end", "novelty")
    shared = docs.sparkSession.sparkContext.broadcast(    # at most PARTS short words
        dictionary(docs, id_col=id_col, text_col=text_col))
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                      ("novelty", pa.float64())])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, texts in slices(batch.column(1)):
            found = [[dict(zip(names, s, strict=True)) for s in find(t, shared.value)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[lo:hi], pa.array(found, pa.list_(item))],
                names=[id_col, "spans"])

    return map_batches(docs.select(id_col, text_col), run,
                       f"`{id_col}` {kind(docs, id_col)}, "
                       "spans array<struct<kind:string,start:int,end:int,novelty:double>>")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: secrets of all documents, with the digest of the base spans."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(name: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:BASE]))
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:BASE]),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["novelty"]).alias("novelty"))
