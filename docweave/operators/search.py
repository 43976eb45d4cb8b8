"""Facets, range filters and search over the document table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from docweave.functions.text import extract_tokens, tokens

# Tokens whose places are held at once, or those of one document.
VECTOR_TOKENS = 1 << 18

FACETS = ("database_nm", "table_nm", "source_nm", "media_format")


def facet_terms(documents: DataFrame, facets: Sequence[str] = FACETS) -> DataFrame:
    """Document counts by each value of each facet, nulls left out.

    Documents are counted once per combination of values first, so only that
    small table is expanded to one row per facet.
    """
    combined = documents.groupBy(*facets).agg(F.count(F.lit(1)).alias("_n"))
    long = combined.select(
        "_n",
        F.inline(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in facets])),
    )
    return long.where(F.col("value").isNotNull()).groupBy("facet", "value").agg(F.sum("_n").alias("n"))


def facet_date_range(documents: DataFrame, unit: str = "month", *, by: Sequence[str] = ()) -> DataFrame:
    """Documents per date bucket over all date columns of all sources.

    A document counts once per bucket: buckets are made distinct within the row,
    so a plain count with map-side combine is enough.
    """
    buckets = F.array_distinct(F.transform("date_text", lambda d: F.date_trunc(unit, d)))
    return (
        documents.select(*by, F.explode(buckets).alias("bucket"))
        .groupBy(*by, "bucket")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


def facet_money_range(documents: DataFrame, gap: float, *, by: Sequence[str] = ()) -> DataFrame:
    """Documents per amount bucket over all money columns of all sources."""
    buckets = F.array_distinct(F.transform("money_text", lambda v: F.floor(v / gap) * gap))
    return (
        documents.select(*by, F.explode(buckets).alias("bucket_low"))
        .groupBy(*by, "bucket_low")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )


def filter_any_date(documents: DataFrame, low: str, high: str) -> DataFrame:
    """Documents with any date in ``[low, high)``, whatever its column.

    Stored documents have bounds, and those reach the scan; rows stored without them are read.
    """
    lo, hi = F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")
    if "bounded" in documents.columns:
        over = (F.col("micros_max") >= F.unix_micros(lo)) & (F.col("micros_min") < F.unix_micros(hi))
        documents = documents.where(F.col("bounded").isNull() | over)
    return documents.where(F.exists("date_text", lambda d: (d >= lo) & (d < hi)))


def filter_any_money(documents: DataFrame, low: float, high: float) -> DataFrame:
    """Documents with any amount in ``[low, high)``, whatever its column; bounds as for dates."""
    if "bounded" in documents.columns:
        documents = documents.where(F.col("bounded").isNull() | ((F.col("money_max") >= low) & (F.col("money_min") < high)))
    return documents.where(F.exists("money_text", lambda v: (v >= low) & (v < high)))


def keyword_search(documents: DataFrame, term: str) -> DataFrame:
    """Documents holding ``term`` as a token of their text, with its hit count."""
    found = F.filter(F.flatten(F.transform("text", tokens)), lambda t: t == term.lower())
    # a cheap substring test first: most documents need no tokenizing
    near = F.exists("text", lambda v: F.contains(F.lower(v), F.lit(term.lower())))
    return documents.where(near).withColumn("hits", F.size(found).cast("long")).where(F.col("hits") > 0)


def reversed_tokens(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct tokens per document, forwards and reversed.

    Made distinct within the row: no shuffle.
    """
    return docs.select(key, F.explode(F.array_distinct(tokens(F.col(text)))).alias("token")).withColumn(
        "token_rev", F.reverse("token")
    )


def write_reversed_index(token_table: DataFrame, path: str) -> None:
    """Store reversed tokens in order, so that a suffix scan prunes files and row groups."""
    token_table.repartitionByRange("token_rev").sortWithinPartitions("token_rev").write.mode(
        "errorifexists"
    ).parquet(path)


def leading_wildcard(token_table: DataFrame, suffix: str) -> DataFrame:
    """``*suffix`` search as a prefix range over reversed tokens.

    ``startsWith`` on the stored column reaches the parquet scan.
    """
    return token_table.where(F.startswith("token_rev", F.lit(suffix.lower()[::-1])))


def term_vectors(docs: DataFrame, key: str, text: str, offsets: bool = True) -> DataFrame:
    """Token, frequency, positions and character offsets per document.

    Texts are taken apart by Spark, the places of equal tokens are gathered inside
    the task, many documents at once: a document of any length costs as much as its
    tokens are sorted for, and nothing is shuffled.
    """
    low = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("low"))
    words = low.select("key", extract_tokens(F.col("low")).alias("words"), *(["low"] if offsets else []))
    fields = [T.StructField("key", low.schema["key"].dataType), T.StructField("token", T.StringType())]
    fields += [T.StructField(name, T.LongType()) for name in ("freq", "first_pos")]
    fields += [T.StructField("positions", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("offsets", T.ArrayType(T.LongType()))] if offsets else []

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto = np.cumsum([0, *pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_pylist()])
            at = 0
            while at < batch.num_rows:  # so many documents at once that their tokens stay few
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + VECTOR_TOKENS, side="right")) - 1)
                part = batch.slice(at, to - at)
                yield _vectors(part.column("key"), part.column("words"), part.column("low") if offsets else None)
                at = to

    out = words.mapInArrow(vectors, T.StructType(fields))
    return out.withColumnRenamed("key", key)


def _points(column: pa.Array) -> np.ndarray:
    """Code points of all strings, one after the other."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, body = column.buffers()
    first, last = np.frombuffer(ends, np.int64)[[column.offset, column.offset + len(column)]].tolist()
    text = body.slice(first, last - first).to_pybytes() if last > first else b""
    return np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)


def _starts(distinct: pa.Array, lows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens begin, and where each text does, in code points of all texts.

    A token is a whole run, so a character is part of one if some token has it.
    """
    part = np.zeros(0x110000, bool)
    part[_points(distinct)] = True
    inside = part[_points(lows)]
    first = np.cumsum([0, *pc.fill_null(pc.utf8_length(lows), 0).to_pylist()])
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    border = first[:-1][first[:-1] < len(inside)]
    opens[border] = inside[border]
    return np.flatnonzero(opens), first


def _vectors(keys: pa.Array, words: pa.Array, lows: pa.Array | None) -> pa.RecordBatch:
    """A row for each distinct token of each document."""
    counts = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    named = words.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(counts)), counts)
    pos = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    group = doc * len(named.dictionary) + named.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = group[order][1:] != group[order][:-1]
    begin = np.flatnonzero(new)
    ends, first = np.append(begin, len(order)), order[begin]
    lists = pa.array(ends, pa.int32())
    columns = {
        "key": keys.take(pa.array(doc[first])),
        "token": named.dictionary.take(named.indices.take(pa.array(first))),
        "freq": pa.array(np.diff(ends), pa.int64()),
        "first_pos": pa.array(pos[first], pa.int64()),
        "positions": pa.ListArray.from_arrays(lists, pa.array(pos[order], pa.int32())),
    }
    if lows is not None:
        at, text = _starts(named.dictionary, lows)
        columns["offsets"] = pa.ListArray.from_arrays(lists, pa.array((at - text[doc])[order], pa.int64()))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
