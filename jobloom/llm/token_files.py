"""Token files: documents as token ids, packed with a canonical length-limited Huffman code.

A folder holds two Parquet tables, so any store that Spark reads can hold them.

* ``code``: one row. ``lengths``: the code length of every id (uint8, 0: not used), ``limit``
  the longest. Codes are canonical: by length, then by id.
* ``blocks``: one row per block. ``shard`` and ``block`` give the order; ``start`` is the
  number of ids before the block in its shard. ``docs`` lists the pieces of documents in the
  block: doc_id, a number that only this document has, which piece it is, whether it is the
  whole document, its number of ids and the number of 32-bit words of its code. ``bits`` has
  the codes, most significant bit first; every piece begins on a word, and an empty word ends
  the block. ``checkpoints`` has, for each run of CHECKPOINT ids of a piece, the number of bits
  it takes (uint16 little-endian).

Documents stand in ascending doc_id order, shard after shard. A block is read without any
other one, and inside it every checkpoint can be decoded on its own: the reader decodes all
runs of several blocks side by side, one table look-up per id.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import partitions, prepare, table, utf8
from jobloom.session import new_run_folder, stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
CODE_LIMIT = 18
BLOCK_IDS = 1 << 16
CHECKPOINT = 64
# Words, and runs of letters, whose ids a task keeps.
WORDS_KEPT = 300_000
LETTERS_KEPT = 1_000_000
# Blocks that are decoded side by side.
BLOCKS_TOGETHER = 8

BLOCK_SCHEMA = (
    "shard int, block int, start long, n_ids long, docs array<struct<doc_id:bigint,"
    "number:bigint,piece:int,whole:boolean,n:bigint,words:bigint>>, bits binary, checkpoints binary"
)


def _byte_letters() -> dict[int, str]:
    """How byte-level BPE writes bytes: printable ones as they are, the others, in order,
    from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_TAIL = ".,;:!?|*$%&#"


class _Dependent(Exception):
    """The ids of a word depend on what is around it."""


class _Met(dict):
    """Values by key, made when first asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class WordEncoder:
    """Ids of whole texts by the tokenizers library, with the ids of met words kept.

    The tokenizer's pattern begins a new part at every single space or line end between two
    other characters, whatever stands around it, and at the end of the letters that follow.
    So a text is cut there, and each distinct piece is encoded by the library once: runs of
    letters, which are one part, by its model, the others by the whole tokenizer. Texts with
    other white space are encoded as they are.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids above 65535 do not fit")
        self.letters = _byte_letters()
        self.space = self.letters[0x20]
        self.known = _Met(self._piece)  # words; those behind a line end begin with it
        self.stems: dict[str, bytes] = {}  # letters, with or without a space in front
        self.tails: dict[str, bytes] = {"": b""}
        self.line_end = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _stem(self, stem: str) -> bytes:
        if stem.isascii():
            part = self.space + stem[1:] if stem[0] == " " else stem
        else:
            part = utf8(stem).decode("latin-1").translate(self.letters)
        ids = array("H", [t.id for t in self.tokenizer.model.tokenize(part)]).tobytes()
        self.stems[stem] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a word and the space or line end before it."""
        stem = piece.rstrip(_TAIL)
        letters = stem.removeprefix("\n")
        if not letters.isalpha():
            word = piece.removeprefix("\n")
            if not word or word[0].isspace() or word[-1].isspace():
                raise _Dependent
            return self._whole(piece if piece[0] == "\n" else " " + piece)
        tail = piece[len(stem) :]
        if tail not in self.tails:
            if len(self.tails) > WORDS_KEPT:
                self.tails = {"": b""}
            self.tails[tail] = self._whole(tail)
        if letters is stem:
            stem = " " + stem
            return (self.stems.get(stem) or self._stem(stem)) + self.tails[tail]
        return self.line_end + (self.stems.get(letters) or self._stem(letters)) + self.tails[tail]

    def encode(self, text: str | None) -> bytes:
        """The ids as uint16, in the machine's byte order."""
        if not text:
            return b""
        first, *rest = text.replace("\n", " \n").split(" ")
        if not first or first[-1].isspace():
            return self._whole(text)
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        if len(self.stems) > LETTERS_KEPT:
            self.stems.clear()
        try:
            return self._whole(first) + b"".join(map(self.known.__getitem__, rest))
        except _Dependent:
            return self._whole(text)


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(file: str) -> WordEncoder:
    if file not in _ENCODERS:
        _ENCODERS[file] = WordEncoder(file)
    return _ENCODERS[file]


def code_lengths(counts: np.ndarray, limit: int = CODE_LIMIT) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits, by package-merge. 0 for unused ids."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n > 1 << limit:
        raise ValueError("too many ids for the limit")
    if n == 1:
        lengths[used] = 1
    if n < 2:
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    merged, kinds = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
        both = np.concatenate((leaves, packages))
        by = np.argsort(both, kind="stable")
        merged = both[by]
        kinds.append(by < n)
    need, found = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(kinds):
        chosen = int(leaf[:need].sum())
        found[:chosen] += 1
        need = 2 * (need - chosen)
    lengths[order] = found
    return lengths


class Code:
    """The canonical code of a table of lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        self.limit = int(self.lengths.max(initial=1))
        width = 1 << (self.limit - self.lengths[order])
        begins = np.concatenate(([0], np.cumsum(width)[:-1])) if len(order) else width
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = begins >> (self.limit - self.lengths[order])
        rest = (1 << self.limit) - int(width.sum())
        self.table_ids = np.concatenate((np.repeat(order, width), np.zeros(rest, np.int64))).astype(np.uint16)
        self.table_lengths = self.lengths[self.table_ids].astype(np.uint8)

    def pack(self, pieces: list[np.ndarray]) -> tuple[list[bytes], list[bytes]]:
        """(bits, checkpoints) of every piece; bits fill whole 32-bit words."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        ids = np.concatenate([*pieces, np.empty(0, np.uint16)])
        lengths = self.lengths[ids]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        to = np.cumsum(sizes)
        bits = ends[to] - ends[to - sizes]
        words_of = (bits + 31) // 32
        first_word = np.cumsum(words_of) - words_of
        # Every piece is moved from where it would follow to where its first word is.
        starts = ends[:-1] + np.repeat(first_word * 32 - ends[to - sizes], sizes)
        words = np.zeros(int(words_of.sum()) + 1, np.uint64)
        if len(ids):
            place = starts >> 5
            shift = (64 - (starts & 31) - lengths).astype(np.uint64)
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            sums = np.add.reduceat(self.codes[ids] << shift, first)
            words[place[first]] += sums >> np.uint64(32)
            words[place[first] + 1] += sums & np.uint64(0xFFFFFFFF)
        flat = words.astype(">u4")
        packed, checkpoints = [], []
        for size, end, w, f in zip(
            sizes.tolist(), to.tolist(), words_of.tolist(), first_word.tolist(), strict=True
        ):
            packed.append(flat[f : f + w].tobytes())
            at = np.append(np.arange(end - size, end, CHECKPOINT), end)
            checkpoints.append(np.diff(ends[at]).astype("<u2").tobytes())
        return packed, checkpoints

    def unpack(self, blocks: list[tuple[list[int], list[int], bytes, bytes]]) -> np.ndarray:
        """Ids of blocks (ids of each piece, words of each piece, bits, checkpoints) in a row.
        All runs of all blocks are decoded side by side."""
        words = np.frombuffer(b"".join(b[2] for b in blocks), ">u4").astype(np.uint64)
        steps = np.frombuffer(b"".join(b[3] for b in blocks), "<u2").astype(np.int64)
        sizes, begins, begin = [], [], 0
        for n, w, bits, _ in blocks:
            sizes.append(np.array(n, np.int64))
            begins.append(begin + np.cumsum(w) - np.array(w, np.int64))
            begin += len(bits) // 4
        sizes = np.concatenate([*sizes, np.empty(0, np.int64)])
        begins = np.concatenate([*begins, np.empty(0, np.int64)])
        runs_of = (sizes + CHECKPOINT - 1) // CHECKPOINT
        last = np.cumsum(runs_of)
        runs = np.full(len(steps), CHECKPOINT)
        runs[last[sizes > 0] - 1] = (sizes[sizes > 0] - 1) % CHECKPOINT + 1
        before = np.cumsum(steps) - steps
        at = before + np.repeat(begins * 32 - before[(last - runs_of).clip(max=max(len(steps) - 1, 0))], runs_of)
        ids = np.zeros((len(at), CHECKPOINT), np.uint16)
        down, mask = np.uint64(64 - self.limit), np.uint64((1 << self.limit) - 1)
        for i in range(CHECKPOINT):
            word = at >> 5
            both = (words[word] << np.uint64(32)) | words[word + 1]
            window = (both >> (down - (at & 31).astype(np.uint64))) & mask
            ids[:, i] = self.table_ids[window]
            at = at + np.where(runs > i + 1, self.table_lengths[window], 0)
        return ids[np.arange(CHECKPOINT) < runs[:, None]]


def _block_type() -> pa.Schema:
    doc = [
        ("doc_id", pa.int64()), ("number", pa.int64()), ("piece", pa.int32()),
        ("whole", pa.bool_()), ("n", pa.int64()), ("words", pa.int64()),
    ]
    return pa.schema(
        [
            ("shard", pa.int32()), ("block", pa.int32()), ("start", pa.int64()),
            ("n_ids", pa.int64()), ("docs", pa.list_(pa.struct(doc))),
            ("bits", pa.binary()), ("checkpoints", pa.binary()),
        ]
    )


IDS_SCHEMA = "doc_id long, ids binary, counts binary"


def _encoded(file: str):
    """(doc_id, ids) of every document, and last one row with the counts of the task's ids."""
    kind = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(file), array("H", [END_ID]).tobytes()
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            ids = [encoder.encode(t) + end for t in batch.column(1).to_pylist()]
            counts += np.bincount(np.frombuffer(b"".join(ids), np.uint16), minlength=1 << 16)
            arrays = [batch.column(0), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())]
            yield pa.record_batch(arrays, schema=kind)
        own = pa.array([counts.astype("<i8").tobytes()], pa.binary())
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), own], schema=kind)

    return encoded


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) of the counts of tasks."""
    total = np.zeros(1 << 16, np.int64)
    for batch in batches:
        for counts in batch.column(0).to_pylist():
            total += np.frombuffer(counts, "<i8")
    used = np.flatnonzero(total)
    yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["id", "n"])


class Shards:
    """Ranges of (doc_id, uid) with about equal numbers of documents, one a shard.

    The bounds are as many numbers as there are shards; a doc_id that fills whole shards by
    itself is divided by its rows' own numbers.
    """

    def __init__(self, keys: DataFrame, number: int):
        self.bounds = _quantiles(keys, "place", number)
        values, first, times = np.unique(self.bounds, return_index=True, return_counts=True)
        self.inside = {
            v: (f + 1, _quantiles(keys.where(F.col("place") == v), "uid", k - 1))
            for v, f, k in zip(values.tolist(), first.tolist(), times.tolist()) if k > 1
        }

    def of(self, place: np.ndarray, uid: np.ndarray) -> np.ndarray:
        found = np.searchsorted(self.bounds, place, "right")
        for value, (first, bounds) in self.inside.items():
            here = place == value
            found[here] = first + np.searchsorted(bounds, uid[here], "right")
        return found.astype(np.int32)


def _quantiles(keys: DataFrame, column: str, number: int) -> np.ndarray:
    """What divides the column into so many parts."""
    if number < 2:
        return np.empty(0, np.int64)
    parts = [i / number for i in range(1, number)]
    found = keys.agg(F.percentile_approx(column, parts, max(10_000, 20 * number)).alias("at")).first()
    return np.array(found["at"] or [], np.int64)


PIECE_SCHEMA = (
    "shard int, doc_id long, uid long, piece int, whole boolean, n long, bits binary, checkpoints binary"
)


def _packed(lengths, shards: Shards):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths.value)
        for batch in batches:
            rows, pieces = [], []
            place, uids = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            shard = shards.of(place, uids).tolist()
            columns = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for to, doc_id, uid, data in zip(shard, *columns, strict=True):
                ids = np.frombuffer(data, np.uint16)
                for piece, i in enumerate(range(0, len(ids), BLOCK_IDS)):
                    pieces.append(ids[i : i + BLOCK_IDS])
                    rows.append((to, doc_id, uid, piece, len(ids) <= BLOCK_IDS, len(pieces[-1])))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            arrays += [pa.array(c, pa.binary()) for c in code.pack(pieces)]
            names = ["shard", "doc_id", "uid", "piece", "whole", "n", "bits", "checkpoints"]
            yield pa.record_batch(arrays, names=names)

    return packed


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces, gathered into blocks of at most BLOCK_IDS ids."""
    shard = TaskContext.get().partitionId()
    block, start, held = 0, 0, 0
    docs, bits, checkpoints = [], [], []

    def row():
        return pa.RecordBatch.from_pylist(
            [
                {
                    "shard": shard, "block": block, "start": start, "n_ids": held, "docs": docs,
                    "bits": b"".join([*bits, bytes(4)]), "checkpoints": b"".join(checkpoints),
                }
            ],
            schema=_block_type(),
        )

    for batch in batches:
        for piece in batch.to_pylist():
            if held and held + piece["n"] > BLOCK_IDS:
                yield row()
                block, start, held, docs, bits, checkpoints = block + 1, start + held, 0, [], [], []
            docs.append(
                {k: piece[k] for k in ("doc_id", "piece", "whole", "n")}
                | {"number": piece["uid"], "words": len(piece["bits"]) // 4}
            )
            bits.append(piece["bits"])
            checkpoints.append(piece["checkpoints"])
            held += piece["n"]
    if held:
        yield row()


def write(docs: DataFrame, folder: str, tokenizer_file: str) -> None:
    """Encode all documents and write them, in ascending doc_id order, to a new folder.

    The ids are kept as a table, with their counts; then every document is packed where it
    is, and only packed documents are shuffled into order, once, by ranges that come from
    the ids of documents alone. The driver holds one count per id of the vocabulary, and
    a bound per shard. Null texts are empty ones; rows of one doc_id stand together, null first.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encoded(tokenizer_file), IDS_SCHEMA
    ).write.option("compression", "zstd").parquet(f"{folder}/ids")
    written = spark.read.schema(IDS_SCHEMA).parquet(f"{folder}/ids")
    totals = (
        written.where("counts IS NOT NULL").select("counts").mapInArrow(_summed, "id long, n long")
        .groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(1 << 16, np.int64)
    counts[totals.column("id").to_numpy()] = totals.column("n").to_numpy()
    lengths = code_lengths(counts)
    code_row = [(bytearray(lengths.tobytes()), CODE_LIMIT)]
    spark.createDataFrame(code_row, "lengths binary, `limit` int").write.parquet(f"{folder}/code")
    ids = written.select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("place"),
        F.monotonically_increasing_id().alias("uid"), "ids", "counts",
    ).where("counts IS NULL")
    number = partitions(spark)
    shards = Shards(ids.select("place", "uid"), number)
    (
        ids.select("doc_id", "place", "uid", "ids")
        .mapInArrow(_packed(spark.sparkContext.broadcast(lengths), shards), PIECE_SCHEMA)
        .repartitionById(number, "shard")
        .sortWithinPartitions("shard", "doc_id", "uid", "piece")
        .mapInArrow(_blocks, BLOCK_SCHEMA)
        .write.parquet(f"{folder}/blocks")
    )


def read(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """The files, decoded: one row per piece of a document, long documents have several.

    doc_id, shard, number (of the document; a long one may lie in two shards), piece, whole,
    start (ids before the piece in the whole folder), n, ids_crc32 and, if asked for, ids of the piece.
    """
    prepare(spark)
    lengths = np.frombuffer(spark.read.parquet(f"{folder}/code").first().lengths, np.uint8)
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCKS_TOGETHER):
                yield _pieces(batch.slice(i, BLOCKS_TOGETHER).to_pylist(), code, with_ids)

    pieces = blocks.select("shard", "start", "n_ids", "docs", "bits", "checkpoints").mapInArrow(
        decoded,
        "doc_id long, shard int, number long, piece int, whole boolean, start long, n long,"
        " ids_crc32 long" + ", ids array<int>" * with_ids,
    )
    # One row per shard: the ids of all shards before it.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (
        blocks.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
        .select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))
    )
    return pieces.join(F.broadcast(shards), "shard").select(
        "doc_id", "shard", "number", "piece", "whole",
        (F.col("start") + F.col("before")).alias("start"), "n", "ids_crc32",
        *["ids"] * with_ids,
    )


def _pieces(blocks: list[dict], code: Code, with_ids: bool) -> pa.RecordBatch:
    rows: dict[str, list] = {
        k: [] for k in ("doc_id", "shard", "number", "piece", "whole", "start", "n", "ids_crc32")
    }
    flat = code.unpack(
        [
            ([d["n"] for d in b["docs"]], [d["words"] for d in b["docs"]], b["bits"], b["checkpoints"])
            for b in blocks
        ]
    )
    to = 0
    for block in blocks:
        ids = flat[to : to + block["n_ids"]]
        to += len(ids)
        data = memoryview(ids.astype("<u4").tobytes())
        at = 0
        for doc in block["docs"]:
            for k in ("doc_id", "number", "piece", "whole", "n"):
                rows[k].append(doc[k])
            rows["shard"].append(block["shard"])
            rows["start"].append(block["start"] + at)
            rows["ids_crc32"].append(zlib.crc32(data[4 * at : 4 * (at + doc["n"])]))
            at += doc["n"]
    kinds = {
        "shard": pa.int32(), "piece": pa.int32(), "whole": pa.bool_(),
    }
    arrays = [pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()]
    if not with_ids:
        return pa.record_batch(arrays, names=list(rows))
    ends = np.cumsum([0, *rows["n"]])
    values = pa.array(flat.astype(np.int32))
    arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
    return pa.record_batch(arrays, names=[*rows, "ids"])


@F.udf(T.LongType())
def _joined_crc(pieces) -> int:
    """crc32 over all pieces of a document, (piece, n, crc) in order."""
    crc = 0
    for p in pieces:
        nothing = bytes(4 * p.n)
        crc = p.ids_crc32 ^ zlib.crc32(nothing, crc) ^ zlib.crc32(nothing)
    return crc


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the files alone: doc_id, start, n_tokens, ids_crc32.

    A document in several pieces gets the checksum of all its ids from those of the pieces.
    """
    pieces = stage(read(spark, folder, with_ids=False), "token-pieces")
    whole = pieces.where("whole").select("doc_id", "start", F.col("n").alias("n_tokens"), "ids_crc32")
    long = (
        pieces.where("not whole")
        .groupBy("number")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.sum("n").alias("n_tokens"),
            F.sort_array(F.collect_list(F.struct("piece", "n", "ids_crc32"))).alias("pieces"),
        )
        .select("doc_id", "start", "n_tokens", _joined_crc("pieces").alias("ids_crc32"))
    )
    return whole.unionByName(long)


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_run_folder(spark, "token-files")
    write(docs, folder, tokenizer_file())
    return digests(spark, folder)
