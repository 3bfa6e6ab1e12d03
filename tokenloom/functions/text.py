"""Text columns: cell to string, message lists to text, dataset names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

NULL_TEXT = "None"
PART_SEPARATOR = "\n\n"


def strip(col: Column) -> Column:
    """Remove surrounding whitespace, Unicode blanks included."""
    return F.btrim(col, F.lit(WHITESPACE))


def to_text(col: Column, data_type: T.DataType | None = None, null_as_empty: bool = False) -> Column:
    """Any cell as a string; NULL becomes ``"None"`` unless ``null_as_empty``.

    Booleans are spelled ``True``/``False`` when ``data_type`` says the column holds them.
    """
    text = col.cast("string")
    if isinstance(data_type, T.BooleanType):
        text = F.initcap(text)
    return F.coalesce(text, F.lit("" if null_as_empty else NULL_TEXT))


def message_contents(messages: Column, element: T.DataType) -> Column:
    """The content string of each message: a ``content`` field, or the plain value itself."""
    if isinstance(element, T.StructType):
        if "content" not in element.fieldNames():
            return F.transform(messages, lambda m: F.lit(""))
        return F.transform(messages, lambda m: m["content"].cast("string"))
    if isinstance(element, T.MapType):
        return F.transform(messages, lambda m: F.try_element_at(m, F.lit("content")).cast("string"))
    return F.transform(messages, lambda m: to_text(m, element))


def message_part(content: Column) -> Column:
    """One message's contribution: NULL for empty content, otherwise the stripped content.

    Emptiness is judged before stripping, so blank content leaves an empty part behind.
    """
    return F.when(content != "", strip(content))


def flatten_messages(messages: Column, element: T.DataType) -> Column:
    """Non-empty contents, each stripped, separated by a blank line; NULL list gives ``""``."""
    parts = F.transform(message_contents(messages, element), message_part)
    return F.coalesce(F.array_join(parts, PART_SEPARATOR), F.lit(""))


def dataset_name(dataset: Column, subset: Column) -> Column:
    """Last path component plus subset, lower case, blanks as dashes."""
    base = F.element_at(F.split(dataset, "/"), -1)
    return F.replace(F.lower(F.concat_ws("-", base, _present(subset))), F.lit(" "), F.lit("-"))


def raw_slug(dataset: Column, subset: Column, split: Column) -> Column:
    """Folder name of a raw dataset: owner, name, subset and split joined by double underscores."""
    return F.concat_ws("__", F.replace(dataset, F.lit("/"), F.lit("__")), _present(subset), split)


def _present(col: Column) -> Column:
    return F.when(col != "", col)


# Text preparation by name, as jobs name it in their settings.
PREPROCESSORS = {
    None: lambda col, data_type: to_text(col, data_type),
    "flatten_messages": lambda col, data_type: flatten_messages(col, data_type.elementType),
}


def prepare_text(col: Column, data_type: T.DataType, preprocess: str | None = None) -> Column:
    """Apply the named text preparation to a column of the given type."""
    if preprocess not in PREPROCESSORS:
        raise ValueError(f"unknown preprocess {preprocess!r}; known: {sorted(k for k in PREPROCESSORS if k)}")
    return PREPROCESSORS[preprocess](col, data_type)
