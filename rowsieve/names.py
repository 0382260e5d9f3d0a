"""Names and text for the few places where SQL has to be spelled out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T


def quote_part(name: str) -> str:
    """One identifier, such as a column, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def quote_name(identifier: str) -> str:
    """A possibly multi-part name of a table, view or schema."""
    return ".".join(quote_part(part) for part in identifier.split("."))


def quote_text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: The comment of columns that keep what did not fit a schema, by which policies know them under any name.
LEFTOVER = "what did not fit the schema"
LEFTOVER_METADATA = {"comment": LEFTOVER}


def columns_ddl(fields: Iterable[T.StructField]) -> str:
    """Columns as a statement names them, with their comments."""

    def column(field: T.StructField) -> str:
        comment = field.metadata.get("comment")
        said = f" COMMENT {quote_text(comment)}" if comment else ""
        return f"{quote_part(field.name)} {field.dataType.simpleString()}{said}"

    return ", ".join(map(column, fields))
