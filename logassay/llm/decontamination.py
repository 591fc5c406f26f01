"""Benchmark passages in documents, by a positional inverted index in DataFrame functions.

The index holds a posting (term, row, position) for every document token that
any benchmark item uses, and one for the end of every row, whose position is the
row's number of words; it is written to the shared folder. Each window of an
item is looked up by its rarest terms: their posting lists, moved back by the
term's offset in the window, are intersected by grouping. Lists much longer
than the rarest one are not read; what they would have decided is decided with
the words themselves, as every candidate is compared word by word in its text.

A proximity match has all distinct words of a passage (two at least; of ten and
more, all but one) within as many words as the passage has and ``slop`` more, in
any order. Passages are the stretches of a window's size that an item consists
of, and its last window. Such a text holds two of any three distinct words of the
passage, or all if it has fewer, so the lists of the three rarest find every such
text; the words of the text decide. How often a word occurs changes no result.

Texts are read a second time only where a candidate lies: a table of ``BITS``
bits, whatever the input, tells most other rows apart, and a join the rest.
Vocabulary, probes and windows are broadcast while they have at most
``BROADCAST_BYTES``, and joined by a shuffle beyond that.

Results: a null or empty text or item has no words; an item shorter than a
window is one window; rows equal in id and text are judged alike; repeated
items count once per item_id; texts are taken whole; empty tables give empty
results (no benchmark: nothing is hit); extra columns play no part.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logassay.llm.common import packed, row_key, stored, texts_of, unpacked

SIZE = 10
PROBES = 3
SLOP = 8
BROADCAST_BYTES = 16 << 20
BITS = 1 << 20
# The word and the term of a row's end.
END_WORD, END = "\x01", -1
EXACT, NEAR = 0, 1
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OUTSIDE = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
# The same of a text that still has its capitals.
OUTSIDE_CASED = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _low(word: Column) -> Column:
    """A-Z lower-cased and nothing else; plain words take the quick way."""
    plain = F.octet_length(word) == F.length(word)
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))


def _words(text: Column) -> Column:
    """Array of the lower-cased words of a text."""
    spaced = F.trim(F.regexp_replace(F.translate(text, UPPER, UPPER.lower()), f"[{OUTSIDE}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _sized(df: DataFrame, *columns: str) -> DataFrame:
    """Marked for broadcast if its strings and lists of strings, and 40 bytes a row, are few enough bytes."""
    lengths = [
        F.length(F.array_join(c, " ")) if dict(df.dtypes)[c].startswith("array") else F.length(c) for c in columns
    ]
    size = df.agg(F.sum(sum((F.coalesce(x, F.lit(0)) for x in lengths), F.lit(40).cast("long")))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def item_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """phrase, n, the ids (as strings) of the items that have the window, and of those with it as a passage."""
    items = texts_of(benchmark, "item_id", "text").select("item_id", _words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    passage = ((F.col("s") - 1) % size == 0) | (F.col("s") + size > F.size("w"))
    item = F.col("item_id").cast("string")
    return (
        items.where(F.size("w") > 0)
        .withColumn("s", F.explode(starts))
        .select(item.alias("item"), passage.alias("passage"), F.slice("w", F.col("s"), F.lit(size)).alias("w"))
        .groupBy(F.array_join("w", " ").alias("phrase"))
        .agg(
            F.size(F.first("w")).alias("n"),
            F.collect_set("item").alias("items"),
            F.collect_set(F.when(F.col("passage"), F.col("item"))).alias("near_items"),
        )
    )


def postings(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """term, doc_id, _k, at: every document token that is in the vocabulary, and the rows' ends."""
    spaced = F.trim(F.regexp_replace("text", OUTSIDE_CASED, " "))
    found = F.split(F.ltrim(F.concat(spaced, F.lit(f" {END_WORD}"))), " ")
    tokens = docs.select("doc_id", "_k", F.posexplode(found).alias("at", "word")).select(
        "doc_id", "_k", "at", _low(F.col("word")).alias("word")
    )
    return tokens.join(_sized(vocabulary, "word"), "word").select("term", "doc_id", "_k", "at")


def _met(found: Column, need: Column, reach: int, apart: int) -> Column:
    """From a window's postings in one text, moved back to the window's start and sorted: the
    starts where all lists meet, and the places where two come within ``reach`` of each other, of
    which those less than ``apart`` after one already told are left out."""
    never = F.lit(-(1 << 30))

    def step(state: Column, posting: Column) -> Column:
        start = posting["start"]
        last = [F.when(posting["bit"] == 1 << i, start).otherwise(state[f"l{i}"]) for i in range(PROBES)]
        oldest = F.least(*[F.when(need > i, x).otherwise(start) for i, x in enumerate(last)])
        before = lambda c: F.coalesce(F.try_element_at(state[c], F.lit(-1)), never)
        here = (oldest == start) & (start >= 0) & (before("starts") != start)
        other = F.greatest(*[F.when(posting["bit"] != 1 << i, state[f"l{i}"]).otherwise(never) for i in range(PROBES)])
        near = (start - other <= reach) & (before("near") <= start - apart)
        return F.struct(
            *[x.alias(f"l{i}") for i, x in enumerate(last)],
            F.when(here, F.array_append(state["starts"], start)).otherwise(state["starts"]).alias("starts"),
            F.when(near, F.array_append(state["near"], start)).otherwise(state["near"]).alias("near"),
        )

    none = F.array().cast("array<int>")
    empty = F.struct(*[never.alias(f"l{i}") for i in range(PROBES)], none.alias("starts"), none.alias("near"))
    return F.aggregate(found, empty, step)


def _least_words(window: Column) -> Column:
    """So many of a window's distinct words make a proximity match."""
    m = F.size(window)
    return F.greatest(m - F.when(m >= 10, 1).otherwise(0), F.lit(2))


def _near(words: Column, window: Column, span: Column) -> Column:
    """Whether enough distinct words of the window lie within ``span`` words of the text."""
    starts = F.filter(
        F.transform(words, lambda w, i: F.when(F.array_contains(window, w), i + 1)), lambda i: i.isNotNull()
    )
    enough = lambda held: F.size(F.array_intersect(held, window)) >= _least_words(window)
    # All the words first, which most fail at once.
    return F.when(enough(words), F.exists(starts, lambda i: enough(F.slice(words, i, span)))).otherwise(False)


def _around(words: Column, place: Column, size: int, slop: int) -> Column:
    """The words around a place that lists came near at: all that a match told there can hold.

    A match's words lie within ``size + slop`` of each other, its lists are moved back by less than
    ``size``, and places up to ``size`` further on were told by this one.
    """
    begin = F.greatest(place - (size + slop), F.lit(0))
    return F.slice(words, begin + 1, F.lit(2 * (size + slop) + 3 * size))


def _probes(windows: DataFrame, vocabulary: DataFrame, index: DataFrame) -> DataFrame:
    """kind, wid, term, off, need, bit: the lists to read for exact places and for proximity matches."""
    terms = windows.select("wid", "passage", F.posexplode(F.split("phrase", " ")).alias("off", "word"))
    lists = index.where(F.col("term") != END).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    order = Window.partitionBy("wid").orderBy("df", "off")
    ranked = (
        terms.groupBy("wid", "passage", "word")
        .agg(F.min("off").alias("off"))
        .join(vocabulary, "word")
        .join(lists, "term", "left")
        .withColumn("df", F.coalesce("df", F.lit(0)))
        .withColumn("rank", F.row_number().over(order))
        .withColumn("least", F.first("df").over(order))
        .where(F.col("rank") <= PROBES)
    )
    # Exact places hold every word, so the longer lists need not be read.
    short = (F.col("rank") == 1) | (F.col("df") <= F.greatest(F.col("least") * 4, F.lit(1000)))
    exact = ranked.where((F.col("least") > 0) & short).withColumn("kind", F.lit(EXACT))
    near = ranked.where("passage").withColumn("kind", F.lit(NEAR))
    return exact.unionByName(near).select(
        "kind", "wid", "term", "off", F.count(F.lit(1)).over(Window.partitionBy("kind", "wid")).alias("need"),
        F.expr("shiftleft(1, rank - 1)").alias("bit"),
    )


def candidates(
    index: DataFrame, windows: DataFrame, vocabulary: DataFrame, size: int, slop: int, near: bool
) -> DataFrame:
    """Per document row: possible exact places and, if ``near``, passages with a possible proximity match."""
    probes = stored(_probes(windows, vocabulary, index).where(F.lit(near) | (F.col("kind") == EXACT)), "probes")
    listed = (
        index.join(_sized(probes), "term")
        .groupBy("kind", "wid", "doc_id", "_k")
        .agg(
            F.bit_or("bit").alias("bits"),
            F.first("need").alias("need"),
            F.collect_list(F.struct((F.col("at") - F.col("off")).alias("start"), "bit")).alias("found"),
        )
        .where(F.bit_count("bits") >= F.when(F.col("kind") == EXACT, F.col("need")).otherwise(F.least("need", F.lit(2))))
        .select("kind", "wid", "doc_id", "_k", _met(F.array_sort("found"), F.col("need"), 2 * size + slop, size).alias("met"))
    )
    places = F.when(F.col("kind") == EXACT, F.col("met.starts")).otherwise(F.col("met.near"))
    both = listed.select("kind", "wid", "doc_id", "_k", F.explode(places).alias("start"))
    exact = F.col("kind") == EXACT
    return (
        both.join(_sized(windows, "phrase", "items", "near_items"), "wid")
        .groupBy("doc_id", "_k")
        .agg(
            F.collect_list(F.when(exact, F.struct("start", "n", "phrase", "items"))).alias("places"),
            F.collect_list(F.when(~exact, F.struct("start", "n", "phrase", "near_items"))).alias("near"),
        )
    )


def _marked(keys: DataFrame) -> Column:
    """Whether a row's ``_k`` may be among the keys: a table of ``BITS`` bits, at most BITS / 64 rows here."""
    at = f"pmod(_k, {BITS}L)"
    mask = f"shiftleft(1L, cast({at} & 63L AS int))"
    rows = keys.groupBy(F.expr(f"cast({at} div 64 AS int)").alias("word")).agg(F.expr(f"bit_or({mask})").alias("bits"))
    table = [0] * (BITS // 64)
    for r in rows.collect():
        table[r.word] = r.bits
    held = F.from_json(F.lit(json.dumps(table)), "array<bigint>")
    return F.get(held, F.expr(f"cast({at} div 64 AS int)")).bitwiseAND(F.expr(mask)) != 0


def _same_row() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key"))


def hits(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slop: int = SLOP, near: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The ends of all rows (doc_id, _k, n_words), and per row with candidates n_hit, items and near_items."""
    rows = texts_of(docs, "doc_id", "text").withColumn("_k", row_key())
    windows = item_windows(benchmark, size).withColumn("wid", F.monotonically_increasing_id())
    windows = stored(windows.withColumn("passage", F.size("near_items") > 0), "windows")
    words = windows.select(F.explode(F.split("phrase", " ")).alias("word")).distinct()
    vocabulary = words.withColumn("term", F.monotonically_increasing_id()).unionAll(
        docs.sparkSession.createDataFrame([(END_WORD, END)], "word string, term long")
    )
    vocabulary = stored(vocabulary, "vocabulary")
    index = stored(postings(rows, vocabulary), "postings")
    ends = index.where(F.col("term") == END).select("doc_id", "_k", F.col("at").cast("long").alias("n_words"))
    found = stored(
        candidates(index, windows, vocabulary, size, slop, near).select(
            F.col("doc_id").alias("_id"), F.col("_k").alias("_key"), "places", "near"
        ),
        "candidates",
    )
    texts = rows.where(_marked(found.select(F.col("_key").alias("_k")))).join(found, _same_row())
    # A generated column is made once; a projected one would be made again wherever it is used.
    worded = texts.select("doc_id", "_k", "places", "near", F.explode(F.array(_words(F.col("text")))).alias("words"))
    true = F.array_sort(
        F.filter("places", lambda p: F.array_join(F.slice("words", p["start"] + 1, p["n"]), " ") == p["phrase"])
    )
    close = F.filter(
        "near",
        lambda p: _near(
            _around(F.col("words"), p["start"], size, slop), F.array_distinct(F.split(p["phrase"], " ")), p["n"] + slop
        ),
    )
    judged = worded.select("doc_id", "_k", F.explode(F.array(F.struct(true.alias("true"), close.alias("close")))).alias("x"))
    covered = F.aggregate(
        "x.true",
        F.struct(F.lit(0).alias("reach"), F.lit(0).alias("total")),
        lambda s, p: F.struct(
            F.greatest(s["reach"], p["start"] + p["n"]).alias("reach"),
            (s["total"] + F.greatest(p["start"] + p["n"] - F.greatest(s["reach"], p["start"]), F.lit(0))).alias("total"),
        ),
    )["total"]
    ids = lambda c, f: F.array_sort(F.array_distinct(F.flatten(F.transform(c, lambda p: p[f]))))
    told = judged.select(
        "doc_id", "_k",
        F.struct(
            covered.cast("long").alias("n_hit"), ids("x.true", "items").alias("items"),
            ids("x.close", "near_items").alias("near_items"),
        ).alias("hit"),
    )
    # Rows equal in id and text are judged alike, so one of them tells.
    return ends, told.groupBy(F.col("doc_id").alias("_id"), F.col("_k").alias("_key")).agg(F.first("hit").alias("hit"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slop: int = SLOP, near: bool = True
) -> DataFrame:
    """One row per document row, with counts, a digest of the items, and proximity matches if ``near``."""
    ends, told = hits(docs, benchmark, size, slop, near)
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("hit.n_hit", F.lit(0).cast("long"))
    items = F.coalesce("hit.items", none)
    return ends.join(told, _same_row(), "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.size(F.coalesce("hit.near_items", none)).cast("long").alias("n_near_items"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs``, all columns, without any benchmark window."""
    _, told = hits(docs, benchmark, size, near=False)
    bad = stored(told.where("hit.n_hit > 0").select("_id", "_key"), "contaminated")
    marked = _marked(bad.select(F.col("_key").alias("_k")))
    rows = packed(docs)
    # Only rows that the bit table cannot tell from contaminated ones are joined.
    return (
        rows.where(~marked)
        .unionAll(rows.where(marked).join(bad, _same_row(), "left_anti"))
        .select(unpacked(docs.columns))
    )


_SQL_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, array_to_string(w[k + 1:k + {SIZE}], ' ') AS phrase, least(len(w), {SIZE}) AS n
    FROM i, LATERAL (SELECT unnest(range(greatest(len(w) - {SIZE - 1}, 1))) AS k)
    WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT doc_id, k AS start, n, array_to_string(w[k + 1:k + n], ' ') AS phrase
    FROM (SELECT * FROM d, lengths), LATERAL (SELECT unnest(range(greatest(len(w) - n + 1, 0))) AS k)
), hits AS (SELECT g.doc_id, g.start, g.n, v.item_id FROM grams g JOIN windows v USING (phrase, n)),
words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
), passages AS (
    SELECT row_number() OVER () AS p, item_id, part, len(part) AS n,
        greatest(len(list_distinct(part)) - CASE WHEN len(list_distinct(part)) >= 10 THEN 1 ELSE 0 END, 2) AS least
    FROM (
        SELECT item_id, w[k + 1:k + {SIZE}] AS part
        FROM i, LATERAL (SELECT unnest(range(greatest(len(w) - {SIZE - 1}, 1))) AS k)
        WHERE len(w) > 0 AND (k % {SIZE} = 0 OR k + {SIZE} >= len(w))
    )
), passage_words AS (SELECT DISTINCT p, item_id, n, least, unnest(part) AS word FROM passages),
positions AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS at FROM d),
met AS (
    SELECT p, item_id, n, least, x.doc_id, x.at, x.word
    FROM passage_words v JOIN positions x USING (word)
), close AS (
    SELECT DISTINCT a.doc_id, a.item_id
    FROM met a JOIN met b ON a.p = b.p AND a.doc_id = b.doc_id AND b.at >= a.at AND b.at < a.at + a.n + {SLOP}
    GROUP BY a.p, a.item_id, a.least, a.doc_id, a.at HAVING count(DISTINCT b.word) >= a.least
), near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near_items FROM close GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""
