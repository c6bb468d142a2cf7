"""Nested records to related flat tables, routed by structural variant.

A bottom-up tree automaton gives every JSON value a state: leaves get their
type, an object gets the sorted list of its keys with their states, a list the
join of its elements' states. Spark's variant type runs exactly this automaton
(`schema_of_variant`), so no Python touches a record. Accepting rules then map
the state of each list element to a typed subtype table; the supertype table
keeps the common keys (record, list, position) of every element.

Defined results
* null, empty or invalid bodies (also text after the document, or several documents): no rows
* a body whose object repeats a key: valid, the key's last value counts
* a list given as a lone object: that object is element 0
* any other value where a list is expected: no rows
* elements that are no objects: counted in list_pos, routed to variant 'none'; their values are rows of `residuals`
* absent or ill-typed fields of an element: null in the subtype table; ill-typed
  and undeclared fields: rows of `residuals`, so no value is lost
* extra input columns: ignored; a repeated record_no gives repeated rows
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Places of the lists in a record.
HTML = ("Envelope", "Payload-Metadata", "HTTP-Response-Metadata", "HTML-Metadata")
LISTS = {
    "Links": (*HTML, "Links"),
    "Metas": (*HTML, "Head", "Metas"),
    "Scripts": (*HTML, "Head", "Scripts"),
    "Link": (*HTML, "Head", "Link"),
    "Metadata-Records": ("Envelope", "Payload-Metadata", "WARC-Metadata-Metadata", "Metadata-Records"),
}


@dataclass(frozen=True)
class Rule:
    """An accepting transition: an object whose named children are in the named states."""

    variant: str
    children: dict[str, str] = field(default_factory=dict)


#: First matching rule wins; an object that matches none is an 'open' variant.
RULES: dict[str, tuple[Rule, ...]] = {
    "Links": (
        Rule("anchor_titled", {"path": "STRING", "url": "STRING", "text": "STRING", "title": "STRING"}),
        Rule("anchor", {"path": "STRING", "url": "STRING", "text": "STRING"}),
        Rule("titled", {"path": "STRING", "url": "STRING", "title": "STRING"}),
        Rule("bare", {"path": "STRING", "url": "STRING"}),
        Rule("unaddressed", {"path": "STRING"}),
    ),
    "Metas": (
        Rule("named", {"name": "STRING", "content": "STRING"}),
        Rule("property", {"property": "STRING", "content": "STRING"}),
        Rule("http_equiv", {"http-equiv": "STRING", "content": "STRING"}),
    ),
    "Scripts": (Rule("external", {"path": "STRING", "url": "STRING"}),),
    "Link": (Rule("related", {"path": "STRING", "url": "STRING", "rel": "STRING"}), Rule("bare", {"path": "STRING", "url": "STRING"})),
    "Metadata-Records": (Rule("valued", {"Name": "STRING", "Value": "STRING"}), Rule("named", {"Name": "STRING"})),
}

#: Typed columns of each subtype table (output name -> field).
FIELDS = {
    "Links": {"path": "path", "url": "url", "text": "text", "title": "title", "target": "target"},
    "Metas": {"name": "name", "property": "property", "http_equiv": "http-equiv", "content": "content"},
    "Scripts": {"path": "path", "url": "url"},
    "Link": {"path": "path", "url": "url", "rel": "rel"},
    "Metadata-Records": {"name": "Name", "value": "Value"},
}


def _path(keys) -> str:
    return "$" + "".join(f'["{k}"]' for k in keys)


def get(v: Column, *keys: str, kind: str = "variant") -> Column:
    """The value below v at the keys, null where the path or type does not fit."""
    return F.try_variant_get(v, _path(keys), kind)


def text_at(v: Column, *keys: str) -> Column:
    """The string at the keys; null for any other type."""
    x = get(v, *keys)
    return F.when(F.schema_of_variant(x) == "STRING", get(v, *keys, kind="string"))


def parsed(body: Column) -> Column:
    """The one JSON document in body as a variant, or null. The brackets make trailing text invalid."""
    doc = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    return F.when(get(doc).isNotNull() & F.try_variant_get(doc, "$[1]", "variant").isNull(), F.try_variant_get(doc, "$[0]", "variant"))


def state(v: Column) -> Column:
    """The automaton's state of a value: its canonical shape, all numbers being one leaf state."""
    return F.regexp_replace(F.schema_of_variant(v), r"BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)", "NUMBER")


def route(list_name: Column, v: Column) -> Column:
    """Name of the subtype that accepts the element."""
    is_object = F.schema_of_variant(v).startswith("OBJECT")
    out = F.when(~F.coalesce(is_object, F.lit(False)), "none")
    for name, rules in RULES.items():
        for r in rules:
            ok = list_name == name
            for key, kind in r.children.items():
                ok = ok & (F.schema_of_variant(get(v, key)) == kind)
            out = out.when(ok, r.variant)
    return out.otherwise("open")


def readable(records: DataFrame) -> DataFrame:
    """records, in a session that reads objects with repeated keys (the last value counts) instead of refusing them."""
    records.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return records


def documents(records: DataFrame, key: str = "record_no", body: str = "body") -> DataFrame:
    """(key, doc): valid bodies as variants."""
    return readable(records).select(F.col(key), parsed(F.col(body)).alias("doc")).where("doc is not null")


def elements(records: DataFrame, key: str = "record_no", body: str = "body", lists: dict[str, tuple[str, ...]] = LISTS) -> DataFrame:
    """Supertype table (key, list_name, list_pos, item): one row per list element of any type.

    Narrow: the bodies are parsed once in the scan's stage; nothing is shuffled.
    """
    docs = documents(records, key, body)
    found = []
    for name, path in lists.items():
        x = get(F.col("doc"), *path)
        kind = F.schema_of_variant(x)
        items = F.when(kind.startswith("ARRAY"), get(F.col("doc"), *path, kind="array<variant>")).when(kind.startswith("OBJECT"), F.array(x))
        found.append(F.struct(F.lit(name).alias("list_name"), items.alias("items")))
    per_list = docs.select(key, F.inline(F.array(*found))).where("items is not null")
    return per_list.select(key, "list_name", F.posexplode("items").alias("list_pos", "item"))


def children(records: DataFrame, key: str = "record_no", body: str = "body") -> DataFrame:
    """Supertype rows of the object elements with their state and variant: (key, list_name, list_pos, variant, shape, item)."""
    rows = elements(records, key, body)
    return rows.select(key, "list_name", "list_pos", route(F.col("list_name"), F.col("item")).alias("variant"), state(F.col("item")).alias("shape"), "item").where("variant <> 'none'")


def subtype(records: DataFrame, list_name: str, key: str = "record_no", body: str = "body") -> DataFrame:
    """Typed table of one list: common keys, variant, then its own columns."""
    rows = elements(records, key, body, {list_name: LISTS[list_name]})
    cols = [text_at(F.col("item"), f).alias(c) for c, f in FIELDS[list_name].items()]
    typed = rows.select(key, "list_pos", route(F.lit(list_name), F.col("item")).alias("variant"), *cols)
    return typed.where("variant <> 'none'")


def residuals(records: DataFrame, key: str = "record_no", body: str = "body") -> DataFrame:
    """(key, list_name, list_pos, field, kind, value): what the typed tables can't hold.

    Fields of object elements that are undeclared or no strings, by name; elements that
    are no objects, with field null. value is JSON.
    """
    rows = elements(records, key, body).withColumnRenamed(key, "_k")
    is_object = F.coalesce(F.schema_of_variant("item").startswith("OBJECT"), F.lit(False))
    lone = rows.where(~is_object).select("_k", "list_name", "list_pos", F.lit(None).cast("string").alias("field"), F.col("item").alias("v"))
    objects = rows.where(is_object)
    each = objects.lateralJoin(objects.sparkSession.tvf.variant_explode(F.col("item").outer())).select("_k", "list_name", "list_pos", F.col("key").alias("field"), F.col("value").alias("v"))
    typed = F.lit(False)
    for name, cols in FIELDS.items():
        typed = typed | ((F.col("list_name") == name) & F.col("field").isin(*cols.values()))
    left = each.where(~(typed & (F.schema_of_variant("v") == "STRING")))
    return lone.unionByName(left).select(F.col("_k").alias(key), "list_name", "list_pos", "field", state(F.col("v")).alias("kind"), F.to_json("v").alias("value"))


def record_heads(records: DataFrame, key: str = "record_no", body: str = "body") -> DataFrame:
    """Parent table: one row per valid record with its envelope fields and the page head."""
    d = F.col("doc")
    meta = ("Envelope", "Payload-Metadata")
    response = (*meta, "HTTP-Response-Metadata")
    return documents(records, key, body).select(
        key,
        text_at(d, "Envelope", "Format").alias("format"),
        text_at(d, "Envelope", "Block-Digest").alias("block_digest"),
        text_at(d, "Envelope", "WARC-Header-Metadata", "WARC-Type").alias("record_type"),
        text_at(d, "Envelope", "WARC-Header-Metadata", "WARC-Date").alias("record_date"),
        text_at(d, *meta, "Actual-Content-Type").alias("actual_content_type"),
        text_at(d, *response, "Response-Message", "Status").alias("status"),
        text_at(d, *response, "Headers", "Server").alias("server"),
        text_at(d, *HTML, "Head", "Title").alias("title"),
    )
