"""Fill-in-middle transformation by memoized content-defined chunks.

A rolling hash over the last 32 bytes cuts a text's UTF-8 bytes into chunks, wherever its
top bits are zero. The cuts follow the content, so passages and copies shared by documents
give the same chunks. What a chunk adds to its text is a small summary: how many code points
begin in it, whether it holds a marker, and the bytes at its two ends, where a marker may go
on into the next chunk. A cache keeps the summaries by content; it is a mapping from the
bytes themselves, so a hit is verified by comparing them. Summaries combine from left to
right: the running counts give a text's length and the chunk that holds a cut, and only
that chunk is searched for the place.

Every row is handled where it is read: no shuffle, and no state but the cache, which is
emptied whenever it holds CACHE_BYTES. It only saves work; results do not depend on it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import prepare, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
MARKER_BYTES = 3
PLAIN, PSM, SPM = "plain", "psm", "spm"
PERCENT_CHANGED = 90
PERCENT_SPM = 20
SALT = "1:"

WINDOW = 32  # bytes that decide a cut
CUT_BITS = 8  # a cut every 256 bytes on average
MOST_CHUNK = 1 << 14  # longer chunks are cut at this length
CACHE_BYTES = 32 << 20
_BLOCK = 1 << 20  # bytes that are hashed at one time

# A number for each byte, by a fixed mixing rule.
_mixed = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_GEAR = ((_mixed ^ (_mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)


class Summary(NamedTuple):
    """What a chunk adds to the text around it."""

    points: int  # code points that begin in it
    marked: bool  # it holds a marker
    head: bytes
    tail: bytes


def summary_of(chunk: bytes) -> Summary:
    points = len(chunk) - int(((np.frombuffer(chunk, np.uint8) & 0xC0) == 0x80).sum())
    return Summary(
        points, any(m in chunk for m in MARKERS), chunk[: MARKER_BYTES - 1], chunk[1 - MARKER_BYTES :]
    )


class ChunkCache:
    """Summaries by content, in bounded memory."""

    def __init__(self, most_bytes: int = CACHE_BYTES):
        self.most_bytes = most_bytes
        self.bytes = 0
        self.known: dict[bytes, Summary] = {}

    def __call__(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            if self.bytes > self.most_bytes:
                self.known.clear()
                self.bytes = 0
            found = self.known[chunk] = summary_of(chunk)
            self.bytes += len(chunk) + 300  # what a small entry takes besides
        return found


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places in the bytes where the rolling hash of the last WINDOW bytes cuts.

    The hash of byte i is the sum of the last 32 bytes' numbers, the k-th last shifted k bits
    to the left; it is built by doubling, for all places of a block side by side.
    """
    found = [np.empty(0, np.int64)]
    for begin in range(0, len(data), _BLOCK):
        lead = min(begin, WINDOW - 1)
        total = _GEAR[data[begin - lead : begin + _BLOCK]]
        step = 1
        while step < WINDOW:
            shifted = total.copy()
            shifted[step:] += total[:-step] << np.uint32(step)
            total, step = shifted, 2 * step
        cut = np.flatnonzero(total[lead:] >> np.uint32(32 - CUT_BITS) == 0)
        found.append(cut + begin + 1)
    return np.concatenate(found)


def chunk_ends(start: int, end: int, cuts: np.ndarray) -> list[int]:
    """Where the chunks of the text between two places end; ``cuts`` are places of all texts.
    The first WINDOW bytes give no cut, as the hash there sees the text before."""
    first, last = np.searchsorted(cuts, (start + WINDOW, end))
    ends, before = [], start
    for cut in [*cuts[first:last].tolist(), end]:
        ends += [*range(before + MOST_CHUNK, cut, MOST_CHUNK), cut]
        before = cut
    return ends


class Cuts(NamedTuple):
    n: int
    form: str
    prefix: int | None  # code points
    middle: int | None
    output: bytes


def _place(point: int, data: bytes, ends: list[int], counts: list[int]) -> int:
    """The byte at which the code point of this number begins."""
    i = bisect_right(counts, point)
    if i == len(counts):
        return len(data)
    begin = ends[i - 1] if i else 0
    heads = np.flatnonzero((np.frombuffer(data, np.uint8, ends[i] - begin, begin) & 0xC0) != 0x80)
    return begin + int(heads[point - (counts[i - 1] if i else 0)])


def hash_numbers(doc_id: int | None) -> list[int]:
    """h1 to h4 of a document; a null id counts as an empty one."""
    digits = hashlib.sha256(f"{SALT}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(doc_id: int | None, data: bytes, ends: list[int], summary: ChunkCache) -> Cuts:
    """Cut one text, given as UTF-8 with the ends of its chunks, and put it into its form."""
    counts, marked, tail, begin = [], False, b"", 0
    for end in ends:
        part = summary(data[begin:end])
        marked = marked or part.marked or any(m in tail + part.head for m in MARKERS)
        tail = (tail + part.tail)[1 - MARKER_BYTES :]
        counts.append(part.points)
        begin = end
    counts = list(accumulate(counts))
    n = counts[-1] if counts else 0
    h1, h2, h3, h4 = hash_numbers(doc_id)
    if not n or marked or h3 % 100 >= PERCENT_CHANGED:
        return Cuts(n, PLAIN, None, None, data)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (_place(point, data, ends, counts) for point in (low, high))
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = MARKERS
    if h4 % 100 < PERCENT_SPM:
        return Cuts(n, SPM, low, high - low, b"".join((s, suffix, p, prefix, m, middle)))
    return Cuts(n, PSM, low, high - low, b"".join((p, prefix, s, suffix, m, middle)))


_TYPE = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()),
    ]
)
_SHAPE = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of strings, one after the other, and where each begins."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    summary = ChunkCache()
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = _text_bytes(batch.column(1))
        cuts = cut_places(data)
        rows = []
        places = offsets.tolist()
        for doc_id, start, end in zip(batch.column(0).to_pylist(), places, places[1:]):
            ends = [e - start for e in chunk_ends(start, end, cuts)] if end > start else []
            rows.append(transform(doc_id, data[start:end].tobytes(), ends, summary))
        n, form, prefix, middle, output = zip(*rows)
        values = (n, form, prefix, middle, pa.array(output, pa.binary()).cast(pa.string()))
        arrays = [batch.column(0), *map(pa.array, values, _TYPE.types[1:])]
        yield pa.record_batch([a.cast(t) for a, t in zip(arrays, _TYPE.types)], schema=_TYPE)


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars and output.

    ``docs`` needs doc_id and text; other columns, whatever their names, are not read. n is
    the text's length in code points. A null text counts as empty, an empty text is plain. A
    null doc_id hashes as an empty one. Repeated rows are transformed alike, empty tables
    give no rows. Plain rows have null lengths, and the text itself as output.
    """
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _transformed, _SHAPE
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of.

    No text in another form than plain holds a marker, and none can arise at a marker's
    sides, so the first of each kind is the one that was put there.
    """
    size = MARKER_BYTES + 1
    middle = F.substring_index(output, MIDDLE, -1)
    before = F.substring_index(output, MIDDLE, 1)
    first = lambda marker: F.substr(F.substring_index(before, marker, 1), F.lit(size))
    second = lambda marker: F.substring_index(before, marker, -1)
    return (
        F.when(form == PSM, F.concat(first(SUFFIX), middle, second(SUFFIX)))
        .when(form == SPM, F.concat(second(PREFIX), middle, first(PREFIX)))
        .otherwise(output)
    )


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    return fill_in_middle(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        _sha256(F.col("output")).alias("output_sha256"),
        _sha256(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


# Plain string functions, without chunks.
SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), number AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM doc
), cut AS (
  SELECT doc_id, t, n, least(a, b) AS low, greatest(a, b) AS high,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM number
), part AS (
  SELECT *, substr(t, 1, low) AS p, substr(t, low + 1, high - low) AS m, substr(t, high + 1) AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM part
"""
