"""Repeated runs of three lines: the first occurrence stays, later ones lose their lines.

Lines are the non-empty parts of a text between line feeds. Every three
consecutive lines form a window, known by 128 bits of hash. Among equal windows
the first is the one with the smallest (doc_id, row key, place); the lines
covered by any later one are removed. A removed line therefore always has an
equal one at an earlier place. Windows are judged on the input, not on what is
left.

Windows are counted with partial sums before the shuffle; a window that a third
of all rows share meets its verdict in a join that Spark can split.

Results: null and empty texts and texts of fewer than three lines are left as
they are; empty lines are never counted nor removed; rows equal in id and text
are judged alike, as one; a null id sorts first; long texts are taken whole; an
empty table gives an empty result; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from logassay.llm.common import map_batches, map_texts, packed, row_key, slices, texts_of, unpacked
from logassay.llm.word_arrays import fingerprints, run_hashes, split_words

RUN = 3
LINE_BYTES = np.arange(256) != 0x0A


def windows(docs: DataFrame, run: int = RUN) -> DataFrame:
    """h1, h2, doc_id, _k and ``at`` (number of the first line) of every window."""
    rows = texts_of(docs, "doc_id", "text").withColumn("_k", row_key())
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(raw: list[bytes], rest: dict) -> dict:
        lines = split_words(raw, LINE_BYTES)
        marks, doc = fingerprints(lines), lines.doc
        one, two = run_hashes(marks, run), run_hashes(marks, run, salt=29)
        inside = np.flatnonzero(doc[: len(one)] == doc[run - 1 :]) if len(one) else np.empty(0, dtype=np.int64)
        owner = doc[inside]
        return {
            "h1": one[inside].view(np.int64),
            "h2": two[inside].view(np.int64),
            "doc_id": pa.array([rest["doc_id"][i] for i in owner], pa_type),
            "_k": pa.array([rest["_k"][i] for i in owner], pa.int64()),
            "at": (inside - lines.first[owner]).astype(np.int32),
        }

    pa_type = to_arrow_type(rows.schema["doc_id"].dataType)
    return map_texts(rows, f"h1 long, h2 long, doc_id {kind}, _k long, at int", work)


def later_windows(docs: DataFrame, run: int = RUN) -> DataFrame:
    """doc_id, _k and the starts of windows that occurred before, per row that has any."""
    found = windows(docs, run)
    repeated = (
        found.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "_k", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("h1", "h2", "first")
    )
    return (
        found.join(repeated, ["h1", "h2"])
        .where(~F.struct("doc_id", "_k", "at").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "_k")
        .agg(F.collect_set("at").alias("starts"))
    )


def cut_repeated_lines(docs: DataFrame, run: int = RUN) -> DataFrame:
    """``docs`` with the lines cut from ``text``, and columns n_lines and n_removed (new or replaced)."""
    starts = later_windows(docs, run).select(
        F.col("doc_id").alias("_id"), F.col("_k").alias("_key"), F.col("starts").alias("_starts")
    )
    joined = packed(docs).join(
        starts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_key")), "left"
    ).select("doc", "text", "_starts")

    def cut(text: bytes, begin: list[int] | None) -> tuple[bytes, int, int]:
        lines = text.split(b"\n")
        full = [i for i, line in enumerate(lines) if line]
        if not begin:
            return text, len(full), 0
        gone = {full[s + k] for s in begin for k in range(run)}
        return b"\n".join(line for i, line in enumerate(lines) if i not in gone), len(full), len(gone)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                column = part.column("text")
                raw = pc.fill_null(column.cast(pa.binary()), b"").to_pylist()
                new = [cut(t, s) for t, s in zip(raw, part.column("_starts").to_pylist(), strict=True)]
                text = pc.if_else(column.is_valid(), pa.array([x[0].decode() for x in new], pa.string()), None)
                counts = [pa.array([x[k] for x in new], pa.int64()) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), text, *counts], names=["doc", "text", "n_lines", "n_removed"]
                )

    added = T._parse_datatype_string("text string, n_lines long, n_removed long").fields
    cuts = map_batches(joined, T.StructType([joined.schema["doc"], *added]), run_batches)
    return cuts.select(
        unpacked(docs.columns, text=F.col("text"), n_lines=F.col("n_lines"), n_removed=F.col("n_removed"))
    )


def cut_stage(docs: DataFrame, run: int = RUN) -> DataFrame:
    """The columns of ``docs`` with cut texts; texts of which nothing is left go.

    ``n_chars``, where the table has it, follows the text.
    """
    wide = packed(docs).select("doc", "doc_id", "text")
    cut = cut_repeated_lines(wide, run).where(
        (F.col("n_removed") == 0) | (F.translate("text", "\n", "") != "")
    )
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("doc.n_chars"))
        new["n_chars"] = size.cast(docs.schema["n_chars"].dataType)
    return cut.select(unpacked(docs.columns, **new))


# Lines, windows and first occurrences, written out.
SQL = """
WITH lines AS (
    SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS place
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k FROM lines WHERE line <> ''
), windows AS (
    SELECT doc_id, k,
        line || chr(10) || lead(line) OVER d || chr(10) || lead(line, 2) OVER d AS w
    FROM numbered WINDOW d AS (PARTITION BY doc_id ORDER BY place)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, k) AS r FROM windows WHERE w IS NOT NULL
), gone AS (
    SELECT DISTINCT doc_id, k + o AS k FROM ranked, (SELECT unnest([0, 1, 2]) AS o) WHERE r > 1
), told AS (
    SELECT l.doc_id, l.place, l.line, n.k IS NOT NULL AS full_line, g.k IS NOT NULL AS removed
    FROM lines l
    LEFT JOIN numbered n ON n.doc_id = l.doc_id AND n.place = l.place
    LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.k = n.k
)
SELECT doc_id,
    count(*) FILTER (full_line) AS n_lines,
    count(*) FILTER (removed) AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT removed), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""
