"""Schema-on-read access to JSON text. A bad document or a wrong-typed value is NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOCUMENT = "__document"
STORED = "document"  # column of a table that holds its messages as VARIANT
NESTED = 4  # levels of objects and arrays that are judged without parsing


def parsed(text: Column) -> Column:
    """Parse JSON text once; reuse the result for every path of the row."""
    return F.try_parse_json(text)


def value_at(document: Column, path: str, type_name: str = "string") -> Column:
    """Typed value under a dotted path of a parsed document."""
    return F.try_variant_get(document, f"$.{path}", type_name)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    Filters on a projected expression are pushed below the projection, where the expression is
    evaluated a second time. Filters on generated columns are not; for expressions as costly as
    parsing or decrypting a whole message that is worth a one-element ``inline``.
    """
    fields = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


def with_document(df: DataFrame, text: Column, paths: Sequence[str], booleans: Sequence[str] = ()) -> DataFrame:
    """Parse JSON text once per row, reading only the dotted ``paths``; ``field`` gets the values.

    Values are read as text, those of ``booleans`` as JSON booleans and nothing else. Text that is
    no JSON has no values; that includes text with anything but white space after the document.
    """
    document = F.from_json(text, document_schema(paths, booleans), {"allowSingleQuotes": "false"})
    return once(df, **{DOCUMENT: F.when(is_one_document(text), document)})


def is_one_document(text: Column) -> Column:
    """False where a second document or other text follows the first one.

    Judged on the text without its strings and white space. An object that begins with the text and where
    every closing brace is followed by closing ones only is the whole if opening and closing braces are as
    many. Where a comma follows a brace, pairs of brackets are taken out from the inside: nothing may
    be left of the text, whereas a comma between two documents stays. What is nested more deeply than
    ``NESTED``, or begins or ends otherwise, is parsed for an answer: as the one element of an array
    with something behind it, which leaves no room for a rest.
    """
    unescaped = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    bare = F.regexp_replace(F.when(text.contains("\\"), unescaped).otherwise(text), r'"[^"]*"|\s', "")
    framed = F.try_parse_json(F.concat(F.lit('{"x":['), text, F.lit('],"end":1}')))
    alone = F.try_variant_get(framed, "$.end", "int").isNotNull() & F.try_variant_get(framed, "$.x[1]", "variant").isNull()
    # the function keeps the bare text from being made anew for each look at it
    seen = F.get(F.transform(F.array(bare), _is_one_bare_object), F.lit(0))
    return F.coalesce(seen, alone, F.lit(False))


def _is_one_bare_object(bare: Column) -> Column:
    """True if so, NULL if that takes a parser."""
    one_object = bare.startswith("{") & bare.endswith("}") & ~bare.rlike(r"\}[^,\]}]")
    balanced = F.length(F.replace(bare, F.lit("{"), F.lit(""))) == F.length(F.replace(bare, F.lit("}"), F.lit("")))
    inner = bare
    for _ in range(NESTED):
        inner = F.regexp_replace(inner, r"[{\[][^{}\[\]]*[}\]]", "")
    return F.when(one_object & ((~bare.contains("},") & balanced) | (inner == "")), True)


def stored_document(text: Column) -> Column:
    """The document as a VARIANT to store beside or in place of its text; NULL where it is no JSON."""
    return F.when(is_one_document(text), F.try_parse_json(text))


def with_stored_document(df: DataFrame, document: Column, paths: Sequence[str], booleans: Sequence[str] = ()) -> DataFrame:
    """As ``with_document`` from a stored VARIANT: the scan reads the named paths and nothing else.

    Numbers come in their normal form (``1.50`` as ``1.5``), objects with their keys in order.
    """

    def leaf(path: str) -> Column:
        if path not in booleans:
            return value_at(document, path)
        kind = F.schema_of_variant(value_at(document, path, "variant"))
        return F.when(kind == "BOOLEAN", value_at(document, path, "boolean"))

    def node(tree: dict, prefix: str) -> Column:
        cells = [(leaf(prefix + k) if v is None else node(v, f"{prefix}{k}.")).alias(k) for k, v in tree.items()]
        return F.struct(*cells)

    return df.withColumn(DOCUMENT, node(_tree(paths), ""))


def with_message(df: DataFrame, paths: Sequence[str], booleans: Sequence[str] = (), text: str = "message", stored: str = STORED) -> DataFrame:
    """The stored document of a table that has one, else its text, parsed."""
    kinds = dict(df.dtypes)
    if kinds.get(stored) == "variant":
        return with_stored_document(df, F.col(stored), paths, booleans)
    return with_document(df, F.col(text), paths, booleans)


def document_schema(paths: Sequence[str], booleans: Sequence[str] = ()) -> str:
    """DDL of the nested structs that hold the paths, every leaf a string or one of ``booleans``."""

    def ddl(node: dict, prefix: str) -> str:
        kinds = [(k, _leaf_type(f"{prefix}{k}", booleans) if v is None else f"struct<{ddl(v, f'{prefix}{k}.')}>") for k, v in node.items()]
        return ",".join(f"`{k}`:{kind}" for k, kind in kinds)

    return f"struct<{ddl(_tree(paths), '')}>"


def _leaf_type(path: str, booleans: Sequence[str]) -> str:
    return "boolean" if path in booleans else "string"


def _tree(paths: Sequence[str]) -> dict:
    """Nested dicts of the parts of dotted paths; a leaf is None."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for part in parents:
            node = node.setdefault(part, {})
            if node is None:
                raise ValueError(f"{path} lies below another listed path")
        if node.setdefault(leaf, None) is not None:
            raise ValueError(f"{path} holds another listed path")
    return tree


def field(path: str, type_name: str = "string") -> Column:
    """Typed value of a path named in ``with_document``; NULL where the text does not fit the type."""
    column = F.col(DOCUMENT)
    for part in path.split("."):
        column = column.getField(part)
    return column if type_name == "string" else column.try_cast(type_name)


def field_equals(path: str, value: int | bool | str) -> Column:
    """Typed comparison with a value of the document; missing or wrong-typed does not match.

    A path that is compared with a boolean belongs to the ``booleans`` of the document.
    """
    if isinstance(value, bool):
        return F.coalesce(field(path).cast("string") == str(value).lower(), F.lit(False))
    return F.coalesce(field(path, {int: "int", str: "string"}[type(value)]) == F.lit(value), F.lit(False))


def can_json_parse(text: Column) -> Column:
    """True for well-formed JSON, false otherwise, NULL for NULL."""
    return F.when(text.isNotNull(), parsed(text).isNotNull())


def json_extract_path_text(text: Column, key: str) -> Column:
    """Top-level value as text; JSON null gives NULL."""
    return F.get_json_object(text, f"$['{key}']")


def first_array_element(text: Column) -> Column:
    """First element of a JSON array held as text."""
    return F.get_json_object(text, "$[0]")


def first_value_or_self(text: Column, key: str = "events") -> Column:
    """JSON text of the first value of the object under ``key``, or the whole document.

    The inner keys are type URIs that are not known in advance, hence the map.
    """
    inner = F.from_json(F.get_json_object(text, f"$.{key}"), "map<string,string>")
    return F.coalesce(F.get(F.map_values(inner), F.lit(0)), text)
