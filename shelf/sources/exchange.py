"""Export files for readers: a ZIP of members, each a list of lines, with small information members."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_members(lines: DataFrame, folder: str, member: str = "member", order: list[str] | None = None) -> None:
    """Lines as text, one folder per member, each member's lines in order and in one file: the form for a cluster."""
    ordered = lines.repartition(member).sortWithinPartitions(member, *(order or []))
    ordered.select(member, F.regexp_replace("line", "\r\n$", "\r").alias("value")).write.mode("overwrite").partitionBy(member).text(folder)


def write_zip(lines: DataFrame, path: str, *, member: str = "member", order: list[str] | None = None, members: list[str] | None = None, info: dict[str, str] | None = None, comment: str = "") -> None:
    """Lines as members of one ZIP, published by a rename; members without lines are written empty.

    Rows stream through the driver in order, a partition at a time; at most one member is open.
    """
    hidden = os.path.join(os.path.dirname(path) or ".", f".{os.path.basename(path)}.part")
    ordered = lines.select(member, "line", *[c for c in (order or []) if c not in (member, "line")]).orderBy(member, *(order or []))
    written: set[str] = set()
    try:
        with zipfile.ZipFile(hidden, "w", zipfile.ZIP_DEFLATED) as z:
            open_, name = None, None
            for row in ordered.toLocalIterator():
                if row[member] != name:
                    if open_:
                        open_.close()
                    name = row[member]
                    open_ = z.open(name, "w")
                    written.add(name)
                open_.write(row["line"].encode())
            if open_:
                open_.close()
            for empty in members or []:
                if empty not in written:
                    z.writestr(empty, b"")
            for key, text in (info or {}).items():
                z.writestr(key, text)
            z.comment = comment.encode()
        os.replace(hidden, path)
    finally:
        if os.path.exists(hidden):
            os.remove(hidden)


def collection_info(database: str, dump_date: str, template: str = "{database} - {display_date}\r\n{file}\r\n65536\r\n{database}\r\n") -> str:
    """The text that names a collection; the template may use database, dump_date, display_date and file."""
    shown = f"{dump_date[:4]}-{dump_date[4:6]}-{dump_date[6:]}" if len(dump_date) == 8 and dump_date.isdigit() else dump_date
    return template.format(database=database, dump_date=dump_date, display_date=shown, file=f"{database}_{dump_date}".strip("_"))


def version_info(dump_date: str) -> str:
    return f"{dump_date}\r\n"


def structure_info(fields: str) -> str:
    """The text that names a layout's fields."""
    return f"{fields}\r\n"


def zip_comment(database: str, dump_date: str) -> str:
    """What a ZIP says about itself."""
    return f"{database}_{dump_date}".strip("_")


def render_template(template: str, **values: str) -> str:
    """A user's template of an information member: {name} for each value, unknown names are an error, lines end in CR LF."""
    try:
        text = template.format(**values)
    except (KeyError, IndexError, ValueError) as error:
        raise ValueError(f"template: {error}") from None
    return "\r\n".join(text.replace("\r\n", "\n").split("\n"))
