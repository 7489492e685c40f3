"""Shape-shifting members (VARIANT): scalar, list or object, read by alias without a fixed schema."""

from __future__ import annotations

import itertools
import json

import pandas as pd
from pyspark.sql import Column, functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``. Inside the function of a higher-order
    expression, anything that is not its variable would be worked out again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def names(words) -> Column:
    """A constant array of words, parsed once instead of built word by word."""
    return F.expr("array(" + ", ".join("'" + w.replace("'", "\\'") + "'" for w in words) + ")")


def none_of(kind: str) -> Column:
    """An empty list or map of a type."""
    return F.expr(f"cast({'map' if kind.startswith('map') else 'array'}() as {kind})")


def get(v, path: str, kind: str = "string") -> Column:
    """Member of a variant object, null when missing or of another type."""
    return F.try_variant_get(col(v), f"${path}" if path.startswith("[") else f"$.{path}", kind)


def as_type(v, kind: str) -> Column:
    return F.try_variant_get(col(v), "$", kind)


def as_text(v) -> Column:
    """Scalar as text; objects and lists as their JSON."""
    return F.try_variant_get(col(v), "$", "string")


def is_object(v) -> Column:
    return F.coalesce(F.schema_of_variant(col(v)).startswith("OBJECT"), F.lit(False))


def is_array(v) -> Column:
    return F.coalesce(F.schema_of_variant(col(v)).startswith("ARRAY"), F.lit(False))


def is_text(v) -> Column:
    return F.coalesce(F.schema_of_variant(col(v)) == "STRING", F.lit(False))


def is_int(v) -> Column:
    return F.coalesce(F.schema_of_variant(col(v)) == "BIGINT", F.lit(False))


def items(v) -> Column:
    """List items of a variant; an empty list for any other shape."""
    return F.coalesce(F.try_variant_get(col(v), "$", "array<variant>"), none_of("array<variant>"))


def nonempty(v) -> Column:
    """True for anything but null, blank text, an empty list or an empty object."""
    t = F.trim(as_text(v))
    return t.isNotNull() & ~t.isin("", "[]", "{}")


def truthy(v) -> Column:
    """Truthiness of a variant: non-empty, not false, not zero."""
    t = F.lower(as_text(v))
    return t.isNotNull() & ~t.isin("", "[]", "{}", "false", "0", "0.0")


def first_truthy(*vs) -> Column:
    """First truthy alias as text."""
    return F.coalesce(*[F.when(truthy(v), as_text(v)) for v in vs])


def members(v) -> Column:
    """Members of a variant object as map<string,variant>; null for any other shape."""
    return F.try_variant_get(col(v), "$", "map<string,variant>")


def pick_member(m, aliases) -> Column:
    """First non-blank alias in a map of members, trimmed. One lambda over the alias list keeps the
    plan small however many aliases there are."""
    texts = F.transform(names(aliases), lambda a: F.trim(as_text(F.try_element_at(col(m), a))))
    return F.get(F.filter(texts, lambda x: x != ""), F.lit(0))


def pick(v, *aliases: str) -> Column:
    """First non-blank alias of an object, trimmed."""
    if len(aliases) > 2:
        return let(members(v), lambda m: pick_member(m, aliases))
    return F.coalesce(*[non_blank(get(v, a)) for a in aliases])


def non_blank(c) -> Column:
    """Trimmed text, null when blank."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def first_non_blank(*cs) -> Column:
    return F.coalesce(*[non_blank(c) for c in cs])


def present(c, kind: str = "text") -> Column:
    """Non-empty test over a typed column: text, list/map or any scalar."""
    c = col(c)
    if kind == "text":
        return F.coalesce(F.trim(c) != "", F.lit(False))
    if kind == "collection":
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def or_default(c, value) -> Column:
    """Missing and null both take the default."""
    return F.coalesce(col(c), F.lit(value))


def first_list(*cs) -> Column:
    """First non-empty list among aliases."""
    return F.coalesce(*[F.when(F.size(items(c)) > 0, items(c)) for c in cs])


def tag_titles(tags) -> Column:
    """Labels of a tag list whose items are text, numbers or {title|name} objects."""
    return F.transform(
        items(tags),
        lambda t: F.coalesce(F.when(is_object(t), F.nullif(get(t, "title"), F.lit(""))),
                             F.when(is_object(t), F.nullif(get(t, "name"), F.lit(""))), as_text(t)),
    )


def member_keys(members) -> Column:
    """Member list as text keys: `value` of an object, or the scalar itself."""
    return F.transform(
        items(members), lambda m: F.coalesce(F.when(is_object(m), get(m, "value")), as_text(m))
    )


def linked_ids(links, *aliases: str) -> Column:
    """Ids of a link list whose items are scalars or objects with an id alias; zero and null go."""
    aliases = aliases or ("id", "case_id")

    def one(x):
        from_object = F.coalesce(*[F.nullif(get(x, a, "bigint"), F.lit(0)) for a in aliases])
        return F.when(is_object(x), from_object).otherwise(
            F.nullif(as_type(x, "bigint"), F.lit(0)))

    return F.filter(F.transform(items(links), one), lambda k: k.isNotNull())


def clean_parameters(parameters) -> Column:
    """Keep {title, values} items that have both; a scalar value becomes a list."""
    def values(p):
        v = F.try_variant_get(p, "$.values", "variant")
        return F.when(is_array(v), F.transform(items(v), as_text)).otherwise(F.array(as_text(v)))

    rows = F.transform(
        F.filter(items(parameters), lambda p: (F.coalesce(get(p, "title"), F.lit("")) != "")
                 & truthy(F.try_variant_get(p, "$.values", "variant"))),
        lambda p: F.struct(get(p, "title").alias("title"), values(p).alias("values")),
    )
    return rows


def clean_shared_steps(steps) -> Column:
    """Blank action becomes `No action`; expected result under either alias."""
    return F.transform(
        items(steps),
        lambda s: F.struct(
            F.coalesce(non_blank(get(s, "action")), F.lit("No action")).alias("action"),
            F.coalesce(F.nullif(get(s, "expected_result"), F.lit("")),
                       F.nullif(get(s, "expected"), F.lit(""))).alias("expected_result"),
        ),
    )


PARAM_NAME = ("title", "Title", "name", "Name", "key", "Key", "parameter", "Parameter")
PARAM_CHOICE = ("selected", "Selected", "selected_value", "selectedValue")


def last_per_key(entries) -> Column:
    """Entries {key, value} with a later one replacing an earlier one of the same key, in place of
    a session-wide map policy."""
    return let(entries, lambda every: F.filter(
        every, lambda e, i: ~F.exists(
            F.slice(every, i + 2, F.size(every)), lambda later: later["key"] == e["key"])))


def param_entries(v) -> Column:
    """Parameters held as an object or as a list of named items -> array<struct<key,value>>;
    null when there are none."""
    as_map = F.try_variant_get(col(v), "$", "map<string,string>")
    of_map = F.transform(
        F.map_entries(as_map),
        lambda e: F.struct(e["key"].alias("key"), F.coalesce(e["value"], F.lit("")).alias("value")),
    )
    named = F.filter(
        F.transform(
            items(v),
            lambda p: F.struct(
                pick(p, *PARAM_NAME).alias("key"),
                F.coalesce(get(p, "value"), get(p, "Value"), pick(p, *PARAM_CHOICE),
                           F.lit("")).alias("value"),
            ),
        ),
        lambda e: e["key"].isNotNull(),
    )
    out = F.when(is_object(v), of_map).when(is_array(v), last_per_key(named))
    return F.when(F.size(out) > 0, out)


def first_params(*sources) -> Column:
    """First source that yields parameters."""
    every = F.transform(F.array(*[col(s) for s in sources]), param_entries)
    return F.get(F.filter(every, lambda e: e.isNotNull()), F.lit(0))


def param_groups(v) -> Column:
    """Text, list or {parameters|items} group -> array<array<string>>; blank groups go."""
    def one(g):
        inner = F.when(is_array(F.try_variant_get(g, "$.parameters", "variant")),
                       items(F.try_variant_get(g, "$.parameters", "variant"))).otherwise(
            items(F.try_variant_get(g, "$.items", "variant")))
        titles = F.filter(F.transform(inner, lambda i: pick(i, "title", "Title", "name", "Name")),
                          lambda t: t.isNotNull())
        listed = F.filter(F.transform(items(g), as_text),
                          lambda t: t.isNotNull() & (F.trim(t) != ""))
        return (F.when(is_object(g), titles).when(is_array(g), listed)
                .when(is_text(g) & (F.trim(as_text(g)) != ""), F.array(F.trim(as_text(g))))
                .otherwise(none_of("array<string>")))

    out = F.filter(F.transform(items(v), one), lambda g: F.size(g) > 0)
    return F.when(F.size(out) > 0, out)


def joined_entries(entries, sep: str = "|") -> Column:
    """`k=v` pairs in key order, joined."""
    return F.array_join(
        F.transform(F.array_sort(entries), lambda e: F.concat(e["key"], F.lit("="), e["value"])), sep
    )


def response_hashes(response, n) -> Column:
    """Hash list of an upload response, padded or cut to the ``n`` files that were sent."""
    r = F.try_variant_get(col(response), "$.result", "variant")
    ok = truthy(F.try_variant_get(col(response), "$.status", "variant"))
    found = (F.when(~ok, none_of("array<string>"))
             .when(is_array(r), F.transform(items(r), lambda i: get(i, "hash")))
             .when(get(r, "hash").isNotNull(), F.array(get(r, "hash")))
             .otherwise(F.transform(items(F.try_variant_get(r, "$.entities", "variant")),
                                    lambda i: get(i, "hash"))))
    n = col(n) if isinstance(n, (str, Column)) else F.lit(n)
    return F.slice(F.concat(found, F.array_repeat(F.lit(None).cast("string"), n)), F.lit(1), n)


def truncate(text, n: int, marker: str = "") -> Column:
    """Cut text at ``n`` characters; ``marker`` may contain {left}, the number cut off."""
    t = col(text)
    if "{left}" in marker:
        head, tail = marker.split("{left}")
        mark = F.concat(F.lit(head), (F.length(t) - n).cast("string"), F.lit(tail))
    else:
        mark = F.lit(marker)
    return F.when(F.length(t) > n, F.concat(F.left(t, F.lit(n)), mark)).otherwise(t)


def capped_keys(m, n: int) -> Column:
    """First ``n`` keys of a map in order."""
    return F.slice(F.array_sort(F.map_keys(col(m))), 1, n)


def cap_members(v, max_keys: int = 80, max_items: int = 200, max_chars: int = 8000) -> Column:
    """Cap the top two levels of a nested value: keys, list items and text length.

    A feature of log lines, not for data. Returns a map of member name to capped text; what is cut is marked, in texts, in
    lists (which keep their first items) and among the members. Deeper levels count as text."""
    entries = F.map_entries(F.try_variant_get(col(v), "$", "map<string,variant>"))

    def one(e):
        n = F.size(items(e["value"]))
        listed = F.concat(F.to_json(F.slice(items(e["value"]), 1, max_items)), F.when(
            n > max_items, F.concat(F.lit("...<truncated "), (n - max_items).cast("string"), F.lit(" items>"))).otherwise(F.lit("")))
        return F.struct(
            e["key"].alias("key"),
            F.when(is_array(e["value"]), listed).otherwise(
                truncate(as_text(e["value"]), max_chars, "...<truncated {left} chars>")).alias("value"),
        )

    kept = F.transform(F.slice(entries, 1, max_keys), one)
    over = F.when(F.size(entries) > max_keys,
                  F.array(F.struct(F.lit("_truncated_keys").alias("key"),
                                   (F.size(entries) - max_keys).cast("string").alias("value")))
                  ).otherwise(none_of("array<struct<key:string,value:string>>"))
    return F.map_from_entries(F.concat(kept, over))


def cap_tree(value, max_depth: int, max_keys: int, max_items: int, max_chars: int):
    """A JSON value with everything cut that a log line should not hold, and a mark where something was cut."""
    def cap(v, depth):
        if depth > max_depth:
            return "<max depth>"
        if isinstance(v, str):
            return v if len(v) <= max_chars else f"{v[:max_chars]}...<truncated {len(v) - max_chars} chars>"
        if isinstance(v, list):
            out = [cap(x, depth + 1) for x in v[:max_items]]
            return out if len(v) <= max_items else [*out, f"...<truncated {len(v) - max_items} items>"]
        if isinstance(v, dict):
            out = {k: cap(v[k], depth + 1) for k in itertools.islice(v, max_keys)}
            return out if len(v) <= max_keys else {**out, "_truncated_keys": len(v) - max_keys}
        return v

    return cap(value, 0)


def cap_nested(v, max_depth: int = 12, max_keys: int = 80, max_items: int = 200, max_chars: int = 8000) -> Column:
    """A nested value as JSON text with its depth, members, list items and text lengths capped: a feature of log lines, not for
    data. The outermost value has depth 0; what lies deeper than ``max_depth`` is `<max depth>`. Null stays null."""
    @F.pandas_udf("string")
    def capped(texts: pd.Series) -> pd.Series:
        def one(text):
            return None if text is None else json.dumps(cap_tree(json.loads(text), max_depth, max_keys, max_items, max_chars), ensure_ascii=False, separators=(",", ":"))

        return texts.map(one)

    return capped(F.to_json(col(v)))
