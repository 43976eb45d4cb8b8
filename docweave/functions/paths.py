"""Links, ids and output locations derived from a file path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: name of the folder that holds formatted copies.
OUTPUT_FOLDER = "PROCESSED_FILES"


def url_path_encode(c: Column) -> Column:
    """Percent-encode each path segment, keeping ``/`` and ``:``.

    Trailing empty segments are dropped.
    """
    segments = F.split(F.regexp_replace(c, "/+$", ""), "/")
    return F.array_join(
        F.transform(
            segments,
            lambda s: F.replace(
                F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")), F.lit("%3A"), F.lit(":")
            ),
        ),
        "/",
    )


def relative_to(path: Column, root: str) -> Column:
    """``path`` without ``root`` where it starts with it."""
    return F.when(F.startswith(path, F.lit(root)), F.substr(path, F.lit(len(root) + 1))).otherwise(path)


def _under(prefix: str, rest: Column) -> Column:
    # exactly one slash between the prefix and the rest
    return F.concat(F.lit(prefix.rstrip("/") + "/"), F.regexp_replace(rest, "^/+", ""))


def web_link(path: Column, prefix: str, root: str) -> Column:
    """Public address of the source file."""
    return url_path_encode(_under(prefix, relative_to(path, root)))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder(path: Column) -> Column:
    """Everything before the last slash."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def output_path(path: Column, out_dir: str | None = None) -> Column:
    """Folder for extracted parts of a file.

    Beside the file the name is cut at its last dot. In a given output folder
    it is cut at the first dot of the path.
    """
    if out_dir is None:
        stem = F.regexp_replace(file_name(path), r"\.[^.]*$", "")
        return F.concat(folder(path), F.lit(f"/{OUTPUT_FOLDER}/"), stem)
    stem = file_name(F.substring_index(path, ".", 1))
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), stem)


def html_link(path: Column, content: Column, prefix: str, root: str, out_dir: str | None = None) -> Column:
    """Address of the formatted copy; null when there is nothing to show."""
    from docweave.functions.media import has_content

    copy = F.concat(relative_to(output_path(path, out_dir), root), F.lit("/"), file_name(path), F.lit(".html"))
    return F.when(has_content(content), url_path_encode(_under(prefix, copy)))


def asset_url(name: Column, prefix: str | None, root: str, out_folder: Column, marker: str = "media") -> Column:
    """Public address of an extracted image.

    From ``marker`` onwards when the name holds it past its start, else below
    the web root, else relative to the output folder, else the bare name.
    """
    if not prefix:
        return name
    at = F.instr(name, marker)
    tail = (
        F.when(at > 1, F.substr(name, at))
        .when(F.startswith(name, F.lit(root)), F.substr(name, F.lit(len(root) + 1)))
        .when(
            F.startswith(out_folder, F.lit(root)),
            F.concat(F.substr(out_folder, F.lit(len(root) + 1)), F.lit("/"), name),
        )
        .otherwise(name)
    )
    return F.concat(F.lit(prefix + "/"), tail)


def record_id(
    path: Column,
    root: str = "",
    kind: str | None = None,
    number: Column | None = None,
    sheet: Column | None = None,
) -> Column:
    """Id of a file, or of its n-th slide, page or row.

    The path is taken relative to the root and without spaces. Rows carry their
    sheet so that sheets of one workbook do not overwrite each other.
    """
    base = F.replace(relative_to(path, root) if root else path, F.lit(" "), F.lit(""))
    parts = [base]
    if sheet is not None:
        parts += [F.lit("#"), F.replace(sheet, F.lit(" "), F.lit("")), F.lit("#")]
    if kind is not None:
        parts += [F.lit(kind), number.cast("string")]
    return F.concat(*parts)


def translated_path(path: Column, location: str, extension: str = "docx") -> Column:
    """Where the translated copy of a file is expected."""
    stem = F.regexp_replace(file_name(path), r"\.[^.]*$", "")
    return F.concat(folder(path), F.lit(f"/{location}/"), stem, F.lit(f".{extension}"))


def original_path(path: Column, location: str, extension: str = "pdf", translated: str = "docx") -> Column:
    """Where the original of a translated copy is expected."""
    moved = F.replace(path, F.lit(f"/{location}/"), F.lit("/"))
    return F.regexp_replace(moved, rf"\.{translated}$", f".{extension}")
