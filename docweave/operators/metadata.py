"""File metadata: multi-valued keys, document info, authors, source tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Document-info key and the metadata key it becomes.
INFO_KEYS = {
    "Title": "title",
    "Author": "creator",
    "Creator": "creator_tool",
    "Keywords": "keywords",
    "Producer": "producer",
    "Subject": "subject",
    "Trapped": "trapped",
    "CreationDate": "created",
    "ModDate": "modified",
}

# Metadata key and the pattern that finds it in tool output.
TOOL_RULES = [
    ("xmpDM:audioChannelType", r"Stream.*? Audio:.*? Hz, (\w+),"),
    ("xmpDM:audioCompressor", r"Stream.*? Audio: (\w+),"),
]


def collect_metadata(entries: Column) -> Column:
    """``array<struct<key,value>>`` of one file as ``map<string,array<string>>``.

    Repeated keys become multi-valued, in order. A file's metadata is in its own
    row, so nothing is shuffled.
    """
    kept = F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull())
    keys = F.array_distinct(kept["key"])
    return F.map_from_arrays(
        keys, F.transform(keys, lambda k: F.filter(kept, lambda e: e["key"] == k)["value"])
    )


def set_metadata(metadata: Column, key: str, value: Column) -> Column:
    """The map with one key overwritten."""
    others = F.map_filter(metadata, lambda k, _: k != key)
    return F.map_concat(others, F.create_map(F.lit(key), F.array(value)))


def document_info(info: Column, page_count: Column) -> Column:
    """Document info as metadata: page count, known keys renamed, others as they are.

    ``created`` and ``modified`` are kept as given. Null values are left out.
    """
    present = F.map_filter(info, lambda _, v: v.isNotNull())

    def new_name(k: Column) -> Column:
        out = k
        for old, new in INFO_KEYS.items():
            out = F.when(k == old, F.lit(new)).otherwise(out)
        return out

    counted = F.create_map(F.lit("page_count"), page_count.cast("string"))
    return F.map_concat(counted, F.transform_keys(present, lambda k, _: new_name(k)))


def author(metadata_author: Column, last_author: Column) -> Column:
    """Author, else last author."""
    return F.coalesce(metadata_author, last_author)


def last_modified(value: Column) -> Column:
    """Modification time where one is given and readable."""
    return F.try_to_timestamp(value)


def source_tags(collection: Column, rules: Sequence[tuple[str, str, Sequence[str]]]) -> Column:
    """``struct(source_nm, categories_nm)`` of a collection name.

    ``rules`` holds (contained word, source name, categories), first match wins,
    ignoring case. Without a match the source is the collection itself.
    """
    none = F.array().cast("array<string>")
    out = F.struct(collection.alias("source_nm"), none.alias("categories_nm"))
    for word, source, categories in reversed(rules):
        tag = F.struct(
            F.lit(source).alias("source_nm"),
            F.array(*[F.lit(c) for c in categories]).cast("array<string>").alias("categories_nm"),
        )
        out = F.when(F.contains(F.lower(collection), F.lit(word.lower())), tag).otherwise(out)
    return F.when(collection.isNotNull(), out)


def tool_metadata(line: Column, rules: Sequence[tuple[str, str]] = TOOL_RULES) -> Column:
    """Metadata entries found in a line of tool output, as ``array<struct<key,value>>``."""
    found = []
    for key, pattern in rules:
        value = F.regexp_extract(line, pattern, 1)
        found.append(F.when(line.rlike(pattern), F.struct(F.lit(key).alias("key"), value.alias("value"))))
    return F.array_compact(F.array(*found))


def merge_rules(base: Sequence[tuple[str, str]], extra: Mapping[str, str]) -> list[tuple[str, str]]:
    """Tool rules with caller rules added or replacing theirs."""
    return [(k, extra.get(k, p)) for k, p in base] + [(k, p) for k, p in extra.items() if k not in dict(base)]
