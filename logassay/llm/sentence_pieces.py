"""Encoding to and decoding from the pieces of a SentencePiece file.

The distinct marked words of a slice of texts are sorted, so that neighbours
share prefixes, and walked as a trie, depth first: the forward states of a
common prefix are computed once. What a state is follows from the file's kind,
which is read from the file:

* unigram files: the best sum of piece scores that ends here, and the piece it
  ends with (Viterbi), in 32-bit arithmetic as the library has it. Sums begin
  with the word; the library's begin with the text, so of two segmentations that
  differ by its rounding alone it may take the other one far into a text;
* merging files (BPE): adding up scores does not give their segmentation, so
  the state is the one piece that ends here and stays apart from the piece
  before it when the merges run by rank.

Characters without a piece become byte pieces, or the unknown piece (one for
neighbours) where a file has no byte pieces. Words end where no piece can reach
across: before a run of marks, and around line feeds. Files of other kinds, with
text rules of their own or with pieces across words are refused. Workers keep
two generations of words of bounded bytes; when the younger is full the older
goes, so that words in use stay. Decoding takes the pieces' bytes from one
buffer, by id, for a whole slice of texts.

Results: a null text has no ids and decodes to null; an empty text has none and
decodes to the empty text; rows are independent, so repeated rows, ties and
clashing extra columns change nothing; texts are taken whole; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logassay.llm.common import map_batches, slices

MARK = "▁"
CACHED_BYTES = 64 << 20
CACHED_PAIRS = 2_000_000
WORD_BYTES = 200  # what a cached word takes besides its letters and ids
NEVER = float("inf")
UNIGRAM, MERGING = 1, 2
UNKNOWN_PENALTY = np.float32(10)

_encoders: dict[str, Pieces] = {}


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, raw[at : at + size]
        at += size


def kind_of(raw: bytes) -> int:
    """The kind of a model file; an error where texts would have to be changed before they are cut."""
    parts = dict(fields(raw))
    trained, rules = dict(fields(parts.get(2, b""))), dict(fields(parts.get(3, b"")))
    kind = trained.get(3, UNIGRAM)
    if kind not in (UNIGRAM, MERGING):
        raise ValueError(f"model files of kind {kind} are not supported")
    if rules.get(2) or rules.get(4, 1) or not rules.get(3, 1) or not rules.get(5, 1) or trained.get(24, 0):
        raise ValueError("the model changes texts before it cuts them")
    return kind


class Pieces:
    """The pieces of a file; one per worker process."""

    def __init__(self, path: str):
        import sentencepiece

        raw = Path(path).read_bytes()
        self.kind = kind_of(raw)
        model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.id: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id: list[int] = []
        self.unknown = model.unk_id()
        shown: list[bytes] = []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id.append(i)
                shown.append(bytes([int(piece[3:5], 16)]))
            elif model.is_unknown(i):
                shown.append(" \u2047 ".encode())
            elif model.is_control(i) or model.is_unused(i):
                shown.append(b"")
            else:
                self.id[piece] = i
                self.score[piece] = model.get_score(i)
                shown.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.id):
            raise ValueError(f"{path}: pieces reach across words")
        self.shown = pa.array(shown, pa.binary())
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0
        if self.kind == MERGING:
            self.rank = {p: -x for p, x in self.score.items()}
            # Pieces that merging can make, and every ending of one.
            self.made = {p for p in self.id if len(self.merges(p)) == 1}
            self.endings = {p[i:] for p in self.made for i in range(len(p))}
            self.spines: dict[str, tuple] = {}
            self.apart: dict[str, dict[str, bool]] = {p: {} for p in self.made}
            self.pairs = 0
        else:
            self.weight = {p: np.float32(x) for p, x in self.score.items()}
            self.longest = max(map(len, self.id), default=1)
            self.least = np.float32(min(self.score.values(), default=0.0)) - UNKNOWN_PENALTY

    def merges(self, text: str) -> list[str]:
        """Symbols left when merges run by rank, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(parts[:-1], parts[1:], strict=True)]
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def spine(self, piece: str) -> tuple[list, list]:
        """Symbols at the piece's left and right end while it is merged, each with birth and death."""
        found = self.spines.get(piece)
        if found is not None:
            return found
        parts, left, right, now = list(piece), [[piece[0], -NEVER]], [[piece[-1], -NEVER]], -NEVER
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(parts[:-1], parts[1:], strict=True)]
            i = ranks.index(min(ranks))
            now = max(now, ranks[i])
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if i == 0:
                left.append([parts[0], now])
            if i == len(parts) - 1:
                right.append([parts[-1], now])
        self.spines[piece] = found = tuple(
            [(s, born, side[k + 1][1] if k + 1 < len(side) else NEVER) for k, (s, born) in enumerate(side)]
            for side in (left, right)
        )
        return found

    def stay_apart(self, one: str, two: str) -> bool:
        """Whether merging the two pieces' characters together ends in just these two."""
        known, rank_of = True, self.rank.get
        for x, x_born, x_dies in self.spine(one)[1]:
            for y, y_born, y_dies in self.spine(two)[0]:
                rank = rank_of(x + y)
                if rank is not None:
                    at = max(rank, x_born, y_born)
                    # Of equal ranks the left merge comes first.
                    if at < x_dies and at <= y_dies:
                        known = False
        if self.pairs > CACHED_PAIRS:
            self.apart, self.pairs = {p: {} for p in self.made}, 0
        self.pairs += 1
        self.apart[two][one] = known
        return known

    def merged(self, words: list[str]) -> Iterator[list[str]]:
        """Per sorted word the piece each of its prefixes ends with, empty where there is none."""
        ids, made, endings, stay_apart = self.id, self.made, self.endings, self.stay_apart
        last: list[str] = [""]
        before = ""
        for word in words:
            del last[common(before, word) + 1 :]
            for end in range(len(last), len(word) + 1):
                begin = end - 1
                chosen = piece = word[begin:end]
                if piece not in ids:
                    last.append("")
                    continue
                while piece in endings:
                    if piece in made:
                        previous = last[begin]
                        if not previous:
                            chosen = piece
                        else:
                            alone = self.apart[piece].get(previous)
                            if stay_apart(previous, piece) if alone is None else alone:
                                chosen = piece
                                break
                    if not begin:
                        break
                    begin -= 1
                    piece = word[begin:end]
                last.append(chosen)
            yield last
            before = word

    def summed(self, words: list[str]) -> Iterator[list[str]]:
        """The same by the best sum of scores; of equal sums the one with the longer last piece stays."""
        weight, longest = self.weight, self.longest
        best: list[np.float32] = [np.float32(0)]
        last: list[str] = [""]
        before = ""
        for word in words:
            shared = common(before, word) + 1
            del last[shared:], best[shared:]
            for end in range(len(last), len(word) + 1):
                top, chosen = None, ""
                for begin in range(max(0, end - longest), end):
                    own = weight.get(word[begin:end])
                    if own is not None:
                        total = own + best[begin]
                        if top is None or total > top:
                            top, chosen = total, word[begin:end]
                if word[end - 1] not in weight:
                    total = self.least + best[end - 1]
                    if top is None or total > top:
                        top, chosen = total, ""
                best.append(top)
                last.append(chosen)
            yield last
            before = word

    def learn(self, words: list[str]) -> None:
        """Segments sorted distinct words; states of prefixes shared with the word before are kept."""
        ids, byte_id = self.id, self.byte_id
        states = self.merged(words) if self.kind == MERGING else self.summed(words)
        for word, last in zip(words, states, strict=True):
            out: list[int] = []
            end = len(word)
            while end:
                piece = last[end]
                if piece:
                    out.append(ids[piece])
                    end -= len(piece)
                else:
                    end -= 1
                    out += [byte_id[b] for b in reversed(word[end].encode())] if byte_id else [self.unknown]
            out.reverse()
            self.keep(word, array("i", out).tobytes())

    def keep(self, word: str, packed: bytes) -> None:
        self.words[word] = packed
        self.held += WORD_BYTES + 4 * len(word) + len(packed)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed 32-bit integers."""
        cut = re.compile(f"{MARK}*[^{MARK}\\n]+|{MARK}+|\\n").findall
        split = [cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if self.held > CACHED_BYTES:
            self.words, self.older, self.held = {}, self.words, 0
        fresh = {w for words in split for w in words}.difference(self.words)
        known = fresh.intersection(self.older)
        for word in known:
            self.keep(word, self.older[word])
        self.learn(sorted(fresh - known))
        packed = [b"".join(map(self.words.__getitem__, words)) for words in split]
        return packed if self.byte_id else [self._one_unknown(p) for p in packed]

    def _one_unknown(self, packed: bytes) -> bytes:
        """Neighbouring unknown characters are one unknown piece."""
        ids = np.frombuffer(packed, dtype="<i4")
        again = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
        return ids[np.append(True, ~again)].tobytes() if len(ids) else packed

    def decode(self, packed: list[bytes]) -> list[str]:
        """The texts of packed ids, cut from one buffer of all their pieces."""
        ids = np.frombuffer(b"".join(packed), dtype="<i4")
        pieces = self.shown.take(pa.array(ids))
        at = np.frombuffer(pieces.buffers()[1], dtype="<i4")[pieces.offset : pieces.offset + len(ids) + 1]
        raw = memoryview(pieces.buffers()[2] or b"")
        edges = at[np.cumsum([0, *(len(p) // 4 for p in packed)])].tolist()
        return [
            bytes(raw[s:e]).removeprefix(b" ").decode(errors="replace") for s, e in zip(edges[:-1], edges[1:], strict=True)
        ]


def common(a: str, b: str) -> int:
    """Length of the shared beginning."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def pieces_of(name: str) -> Pieces:
    """By the name of a public file, or by the path of any file the workers can read."""
    if name not in _encoders:
        import public_tokenizers

        _encoders[name] = Pieces(name if "/" in name else public_tokenizers.path(name))
    return _encoders[name]


def _mapped(table: DataFrame, added: str, work) -> DataFrame:
    """All columns of ``table`` and those ``work`` makes from each slice, which replace any of that name."""
    new = T._parse_datatype_string(added).fields
    df = table.drop(*[f.name for f in new])
    schema = T.StructType([*df.schema.fields, *new])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch) if "text" in batch.schema.names else [batch]:
                yield pa.RecordBatch.from_arrays([*part.columns, *work(part)], names=names)

    return map_batches(df, schema, run)


def _ids(packed: list[bytes | None]) -> pa.Array:
    return pa.array(
        [None if p is None else np.frombuffer(p, dtype="<i4") for p in packed], pa.list_(pa.int32())
    )


def _encoded(name: str, texts: list[str | None]) -> list[bytes | None]:
    full = iter(pieces_of(name).encode([t for t in texts if t is not None]))
    return [None if t is None else next(full) for t in texts]


def _decoded(name: str, packed: list[bytes | None]) -> list[str | None]:
    full = iter(pieces_of(name).decode([p for p in packed if p is not None]))
    return [None if p is None else next(full) for p in packed]


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", column: str = "ids") -> DataFrame:
    """``docs`` with the array of ids of ``text``."""
    return _mapped(
        docs, f"{column} array<int>", lambda part: [_ids(_encoded(model, part.column("text").to_pylist()))]
    )


def decode(df: DataFrame, model: str = "piece_bpe_32k.model", column: str = "ids", to: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids of ``column`` stand for."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        packed = [None if x is None else np.array(x, dtype="<i4").tobytes() for x in part.column(column).to_pylist()]
        return [pa.array(_decoded(model, packed), pa.string())]

    return _mapped(df, f"{to} string", work)


def round_trips(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text, and whether it is the text."""

    def work(part: pa.RecordBatch) -> list[pa.Array]:
        texts = part.column("text").to_pylist()
        packed = _encoded(model, texts)
        back = _decoded(model, packed)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        return [
            pa.array([len(p or b"") // 4 for p in packed], pa.int64()),
            pa.array([digest(p or b"") for p in packed]),
            pa.array([None if t is None else digest(t.encode()) for t in back], pa.string()),
            pa.array([a == b for a, b in zip(back, texts, strict=True)]),
        ]

    told = _mapped(
        docs.select("doc_id", "text"),
        "n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean", work,
    )
    return told.drop("text")
