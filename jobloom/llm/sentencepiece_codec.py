"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

Encoding puts a whitespace marker before the text and for every space, and takes the
segmentation into pieces with the highest sum of log scores; of equal ones that whose last
pieces are longest. Characters that no piece covers cost more than any piece and are written
as their UTF-8 bytes. Decoding joins the pieces, turns markers into spaces, drops the one in
front, and reads runs of byte pieces as UTF-8.

A marker occurs in pieces only at the beginning, so a text falls into words (markers and what
follows up to the next marker) that no piece crosses, and its best segmentation is that of its
words. Each task keeps the segmentations of words it has met.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobloom.llm.common import prepare, table, utf8

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
WORDS_KEPT = 250_000
# Words of at most so many bytes are segmented side by side, so many at a time.
LONGEST_TOGETHER = 64
WORDS_TOGETHER = 20_000
MODEL = "piece_bpe_32k.model"


class DoubleArrayTrie:
    """Strings of bytes in two arrays: the child of state s by byte c is at base[s] + c + 1,
    if check there is s. value is the string's number, or -1."""

    # Nodes with several children look for room among the last so many places.
    RECENT = 1024

    def __init__(self, strings: dict[bytes, int]):
        keys = sorted(strings)
        base, check, value = [0], [0], [-1]
        pending = [(0, 0, len(keys), 0)]  # state, keys from, keys to, depth
        free = 257  # below it, not every code has a place
        while pending:
            state, low, high, depth = pending.pop()
            if low < high and len(keys[low]) == depth:
                value[state] = strings[keys[low]]
                low += 1
            if low == high:
                continue
            children, at = [], low
            while at < high:
                byte, begin = keys[at][depth], at
                while at < high and keys[at][depth] == byte:
                    at += 1
                children.append((byte + 1, begin, at))
            while free < len(check) and check[free] != -1:
                free += 1
            place = free - children[0][0]
            if len(children) > 1:
                place = max(place, len(check) - self.RECENT)
            while any(place + c < len(check) and check[place + c] != -1 for c, _, _ in children):
                place += 1
            more = place + children[-1][0] + 1 - len(check)
            base += [0] * more
            check += [-1] * more
            value += [-1] * more
            base[state] = place
            for code, begin, end in children:
                check[place + code] = state
                pending.append((place + code, begin, end, depth + 1))
        # A last byte must find a place to look at.
        self.base = np.array(base + [0] * 256, np.int32)
        self.check = np.array(check + [-1] * 256, np.int32)
        self.value = np.array(value + [-1] * 256, np.int32)


@dataclass
class Pieces:
    """The vocabulary: pieces and scores by id, the trie of plain pieces, byte pieces."""

    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    trie: DoubleArrayTrie

    def __post_init__(self):
        plain = [s for s, p in zip(self.scores, self.pieces, strict=True) if p]
        self.unknown_score = min(plain, default=0.0) - UNKNOWN_PENALTY
        self._ready()

    def _ready(self) -> None:
        self._base = self.trie.base.tolist()
        self._check = self.trie.check.tolist()
        self._value = self.trie.value.tolist()
        self._known: dict[str, bytes] = {}
        # What each id adds to a text: bytes of a piece, or one byte.
        self._bytes = [utf8(p) for p in self.pieces]
        for byte, i in enumerate(self.byte_ids):
            if i >= 0:
                self._bytes[i] = bytes([byte])
        marker = utf8(MARKER)
        self._bytes = [b.replace(marker, b" ") for b in self._bytes]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    @classmethod
    def of(cls, pieces: list[str], scores: list[float], control: set[int], unknown: int) -> Pieces:
        """``control`` ids stand for no text; ``<0xNN>`` pieces are bytes."""
        byte_ids = [-1] * 256
        plain: dict[bytes, int] = {}
        kept = []
        for i, piece in enumerate(pieces):
            byte = BYTE_PIECE.fullmatch(piece)
            if byte:
                byte_ids[int(byte[1], 16)] = i
            if byte or i in control or i == unknown or not piece:
                kept.append("")
                continue
            if MARKER in piece.lstrip(MARKER):
                raise ValueError(f"piece {i} has a marker behind its beginning")
            kept.append(piece)
            plain.setdefault(utf8(piece), i)
        return cls(kept, scores, byte_ids, unknown, DoubleArrayTrie(plain))

    @classmethod
    def load(cls, model_file: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        return cls.of(
            [model.id_to_piece(i) for i in ids],
            [model.get_score(i) for i in ids],
            {i for i in ids if model.is_control(i) or model.is_unused(i)},
            model.unk_id(),
        )

    def _segment(self, word: str) -> list[int]:
        """The best segmentation of one word."""
        base, check, value, scores = self._base, self._check, self._value, self.scores
        data = utf8(word)
        n = len(data)
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        for at in range(n):
            so_far = best[at]
            if so_far == float("-inf"):
                continue
            length = 1 if data[at] < 0x80 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
            covered = False  # a piece of one character begins here
            state, end = 0, at
            while end < n:
                step = base[state] + data[end] + 1
                if not base[state] or check[step] != state:
                    break
                state, end = step, end + 1
                found = value[state]
                if found >= 0:
                    covered = covered or end == at + length
                    score = so_far + scores[found]
                    # Places come in order, so of equal scores the longest last piece stays.
                    if score > best[end]:
                        best[end], back[end] = score, (at, found)
            if not covered and so_far + self.unknown_score > best[at + length]:
                best[at + length], back[at + length] = so_far + self.unknown_score, (at, -1)
        ids: list[int] = []
        while n:
            at, found = back[n]
            if found >= 0:
                ids.append(found)
            else:
                ids += [self._byte_id(b) for b in reversed(data[at:n])]
            n = at
        return ids[::-1]

    def _byte_id(self, byte: int) -> int:
        return self.byte_ids[byte] if self.byte_ids[byte] >= 0 else self.unknown

    def _segment_many(self, words: list[str]) -> list[bytes]:
        """As ``_segment``, for many words side by side; ids as bytes."""
        datas = [utf8(w) for w in words]
        sizes = np.fromiter(map(len, datas), np.int64, len(datas))
        done: list[bytes | None] = [None] * len(words)
        together = np.flatnonzero(sizes <= LONGEST_TOGETHER)
        for i in range(0, len(together), WORDS_TOGETHER):
            block = together[i : i + WORDS_TOGETHER]
            found = self._viterbi([datas[j] for j in block], sizes[block])
            for j, ids in zip(block.tolist(), found, strict=True):
                done[j] = ids
        for j, ids in enumerate(done):
            if ids is None:
                done[j] = np.array(self._segment(words[j]), np.int32).tobytes()
        return done

    def _viterbi(self, datas: list[bytes], sizes: np.ndarray) -> list[bytes | None]:
        """None for words whose best segmentation has a character that no piece covers."""
        n, longest = len(datas), int(sizes.max(initial=0))
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        scores = np.array(self.scores)
        data = np.zeros((n, longest + 1), np.int32)
        flat = np.frombuffer(b"".join(datas), np.uint8)
        inside = np.arange(longest + 1) < sizes[:, None]
        data[inside] = flat
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0.0
        from_ = np.zeros((n, longest + 1), np.int32)
        piece = np.full((n, longest + 1), -1, np.int32)
        for at in range(longest):
            rows = np.flatnonzero((sizes > at) & (best[:, at] > -np.inf))
            lead = data[rows, at]
            length = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            open_rows, open_length = rows, length
            covered = np.zeros(n, bool)
            state = np.zeros(len(rows), np.int32)
            end = at
            while len(rows):
                step = base[state] + data[rows, end] + 1
                go = (base[state] > 0) & (check[step] == state) & (end < sizes[rows])
                rows, state, length = rows[go], step[go], length[go]
                end += 1
                found = value[state]
                hit = found >= 0
                hits, ids = rows[hit], found[hit]
                covered[hits[length[hit] == end - at]] = True
                score = best[hits, at] + scores[ids]
                better = score > best[hits, end]
                best[hits[better], end] = score[better]
                from_[hits[better], end] = at
                piece[hits[better], end] = ids[better]
                if end == longest:
                    break
            alone = ~covered[open_rows]
            rows, ends = open_rows[alone], at + open_length[alone]
            score = best[rows, at] + self.unknown_score
            better = score > best[rows, ends]
            best[rows[better], ends[better]] = score[better]
            from_[rows[better], ends[better]] = at
            piece[rows[better], ends[better]] = -1
        # Backwards from the ends: the k-th piece from the end of every word.
        place, rows = sizes.copy(), np.arange(n)
        last_first, unknown = [], np.zeros(n, bool)
        count = np.zeros(n, np.int64)
        while True:
            rows = rows[place[rows] > 0]
            if not len(rows):
                break
            ids = piece[rows, place[rows]]
            unknown[rows[ids < 0]] = True
            column = np.full(n, -1, np.int32)
            column[rows] = ids
            last_first.append(column)
            count[rows] += 1
            place[rows] = from_[rows, place[rows]]
        ordered = np.stack(last_first[::-1], 1) if last_first else np.empty((n, 0), np.int32)
        ordered = np.ascontiguousarray(ordered)
        width = ordered.shape[1]
        return [
            None if odd else ordered[i, width - k :].tobytes()
            for i, (odd, k) in enumerate(zip(unknown.tolist(), count.tolist(), strict=True))
        ]

    @staticmethod
    def _words(text: str | None) -> list[str]:
        if not text:
            return []
        words = text.split(" ")
        if "" in words or MARKER in text:
            return re.findall(f"{MARKER}+[^{MARKER}]*", MARKER + text.replace(" ", MARKER))
        return [MARKER + w for w in words]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text."""
        known = self._known
        if len(known) > WORDS_KEPT:
            known.clear()
        split = [self._words(t) for t in texts]
        new = list(set().union(*split).difference(known))
        known.update(zip(new, self._segment_many(new), strict=True))
        return [np.frombuffer(b"".join(map(known.__getitem__, w)), np.int32) for w in split]

    def decode(self, ids) -> str:
        own = self._bytes
        text = b"".join([own[i] for i in ids]).decode("utf-8", "replace")
        return text.removeprefix(" ")


PIECES_TYPE = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]
)


def coded(pieces: Pieces, text: Column, docs: DataFrame) -> Column:
    """A struct (ids, decoded) for each text; the text is decoded from the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    @F.arrow_udf(PIECES_TYPE)
    def both(texts: pa.Array) -> pa.Array:
        codec = shared.value
        rows = codec.encode(texts.to_pylist())
        ends = np.cumsum([0, *map(len, rows)])
        flat = np.concatenate([*rows, np.empty(0, np.int32)])
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        decoded = pa.array([codec.decode(r.tolist()) for r in rows], pa.string())
        return pa.StructArray.from_arrays([ids, decoded], names=["ids", "decoded"])

    return both(text)


def encode_and_decode(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_ids, ids, decoded, round_trip.

    ``docs`` needs doc_id and text; other columns are not read. A null or empty text has no
    ids and decodes to the empty text. round_trip says whether the decoded text is the text;
    a marker character in a text comes back as a space, all else comes back as it was.
    Repeated rows give repeated rows, an empty table none.
    """
    prepare(docs.sparkSession)
    found = docs.select(
        "doc_id", "text", coded(Pieces.load(model_file), docs["text"], docs).alias("found")
    )
    return found.select(
        "doc_id",
        F.size("found.ids").cast("long").alias("n_ids"),
        "found.ids",
        "found.decoded",
        (F.col("found.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def model_file(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"), model_file())
