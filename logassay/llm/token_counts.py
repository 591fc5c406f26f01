"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table of frequent pre-tokens and their lengths in
tokens, at most ``frequent`` entries. They are counted over all texts: a task
keeps its most frequent ones, and only those summaries, of bounded size, meet.
The table decides speed, never a result. Tier two is a worker's cache, at most
``cache_entries`` entries, filled by merging each missed pre-token by rank.
Nothing else is shuffled by pre-token.

Results: a null text counts as empty and has 0 bytes and 0 tokens; each row is
counted by itself, so repeated rows and ids, ties and extra columns change
nothing; an empty table gives an empty result. Texts with characters outside
``PLAIN``, or with the special string, are encoded whole by the library, whose
character classes then decide.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import map_batches, map_texts, slices, stored, texts_of

# The pre-token rule of the vocabulary file, written for the plain
# characters (no numbers but digits), and what counts as plain.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+"
PLAIN = r"[\t\n\r\x20-\x7E\xA1-\xAC\xAE-\xB1\xB4-\xB8\xBA\xBB\xBF-\u024F]*+"
LONGEST_CACHED = 64
# A task's summary: pre-tokens it counts at once, as a multiple of the table, and those it passes on.
COUNTED, PASSED = 10, 2

_vocabularies: dict[str, Vocabulary] = {}
_lengths: dict[str, Lengths] = {}


class Vocabulary:
    """The library's tokenizer and its merges as byte ranks; one per worker process."""

    def __init__(self, name: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = public_tokenizers.path(name)
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, merges = model["vocab"], model["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        if [ids[a + b] for a, b in pairs] != list(range(256, 256 + len(pairs))):
            raise ValueError(f"{name}: ids do not follow the order of merges")
        chars = byte_characters()
        ranks = {bytes(chars[c] for c in piece): i for piece, i in ids.items() if i < 256 + len(pairs)}
        merged = tiktoken.Encoding(name, pat_str="", mergeable_ranks=ranks, special_tokens={})
        self.merge = merged._core_bpe.encode_single_piece
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def count(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def vocabulary_of(name: str) -> Vocabulary:
    if name not in _vocabularies:
        _vocabularies[name] = Vocabulary(name)
    return _vocabularies[name]


class Lengths(dict):
    """Pre-token to number of tokens; a miss is merged and, if short, kept."""

    def __init__(self, vocabulary: Vocabulary, frequent: dict[str, int], entries: int):
        super().__init__(frequent)
        self.merge, self.frequent, self.entries = vocabulary.merge, frequent, entries

    def __missing__(self, piece: str) -> int:
        n = len(self.merge(piece.encode()))
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= self.entries:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def frequent_pre_tokens(df: DataFrame, frequent: int) -> list[str]:
    """The most frequent pre-tokens of all texts, by the tasks' summaries; the driver gets ``frequent`` rows.

    A pre-token that fell out of a task's counts begins anew, so its count may be too low.
    """
    findall = re.compile(PRE_TOKEN).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    found.update(findall(text))
                if len(found) > COUNTED * frequent:
                    found = Counter(dict(found.most_common(COUNTED * frequent // 2)))
        top = [(p, n) for p, n in found.most_common(PASSED * frequent) if len(p) <= LONGEST_CACHED]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"]
        )

    counted = stored(
        map_batches(df.select("text"), "piece string, n long", run).groupBy("piece").agg(F.sum("n").alias("n")),
        "pre-tokens",
    )
    # Each task of a sort sends its first rows; so first the power of two that enough counts reach.
    power = F.floor(F.log2("n")).cast("int")
    reach, least = 0, 0
    for r in sorted(counted.groupBy(power.alias("p")).count().collect(), key=lambda r: -r["p"]):
        reach, least = reach + r["count"], 1 << r["p"]
        if reach >= frequent:
            break
    top = counted.where(F.col("n") >= least).repartition(8)
    return [r.piece for r in top.orderBy(F.desc("n"), "piece").limit(frequent).collect()]


def token_counts(
    docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 512,
    frequent: int = 20_000, cache_entries: int = 400_000,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``) for every row."""
    df = texts_of(docs, "doc_id", "text")
    merge = vocabulary_of(vocabulary).merge
    known = {p: len(merge(p.encode())) for p in frequent_pre_tokens(df, frequent)}
    table, call = docs.sparkSession.sparkContext.broadcast(known), uuid.uuid4().hex

    def count(raw: list[bytes], rest: dict) -> dict:
        voc = vocabulary_of(vocabulary)
        if call not in _lengths:
            # A worker serves one call after another; the cache of the last one goes.
            _lengths.clear()
            _lengths[call] = Lengths(voc, table.value, cache_entries)
        lengths = _lengths[call].__getitem__
        pre_tokens, plain = re.compile(PRE_TOKEN).findall, re.compile(PLAIN).fullmatch
        out = []
        for t in raw:
            text = t.decode()
            if plain(text) and not any(s in text for s in voc.special):
                out.append(sum(map(lengths, pre_tokens(text))))
            else:
                out.append(voc.count(text))
        return {"doc_id": rest["doc_id"], "n_bytes": [len(t) for t in raw], "n_tokens": out}

    kind = df.schema["doc_id"].dataType.simpleString()
    counted = map_texts(df, f"doc_id {kind}, n_bytes long, n_tokens long", count)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
