"""Text expressions: keys embedded in text, titles, messages, names, signatures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .shapes import (
    as_text, col, first_non_blank, is_object, is_text, items, joined_entries, let, members, names, non_blank,
    none_of, pick,
)

# Shapes of an attachment key and of the URLs that carry one.
HEX_KEY = "[a-f0-9]{32,64}"
UUID_KEY = "[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}"
ANY_KEY = f"(?:{HEX_KEY}|{UUID_KEY})"
KEY_IN_URL = f"(?i)/attachments?/({ANY_KEY})/"
STRICT_KEY_IN_URL = f"(?i)/attachment/({HEX_KEY})/"
IMAGE_LINK = rf"(?i)!\[[^\]]*\]\((https://[^\)]+/attachments?/({ANY_KEY})/[^\)]+)\)"
KEY_OF_LINK = rf"(?is)^https://.+/attachments?/({ANY_KEY})/.+$"
WORKSPACE_IN_URL = f"(?i)/public/team/({HEX_KEY})/"


def normal_key(c) -> Column:
    """One spelling per key: no dashes, lower case."""
    return F.lower(F.replace(F.trim(col(c)), F.lit("-"), F.lit("")))


def looks_like_key(c) -> Column:
    """At least 32 hex digits once dashes are dropped."""
    return F.coalesce(normal_key(c).rlike("^[a-f0-9]{32,}$"), F.lit(False))


def embedded_keys(text) -> Column:
    """Distinct keys in a text's URLs, normalised, in order of appearance."""
    found = F.regexp_extract_all(col(text), F.lit(KEY_IN_URL), F.lit(1))
    return F.coalesce(F.array_distinct(F.transform(found, normal_key)),
                      none_of("array<string>"))


def key_of_url(url) -> Column:
    """First key in a URL, null when there is none."""
    return F.nullif(normal_key(F.regexp_extract(col(url), KEY_IN_URL, 1)), F.lit(""))


def embedded_urls(text) -> Column:
    """array<struct<key,url>> of the image links in a text."""
    urls = F.regexp_extract_all(col(text), F.lit(IMAGE_LINK), F.lit(1))  # one pass over the text; keys come from the URLs
    pairs = F.transform(urls, lambda u: F.struct(normal_key(F.regexp_extract(u, KEY_OF_LINK, 1)).alias("key"), u.alias("url")))
    return F.coalesce(pairs, none_of("array<struct<key:string,url:string>>"))


def workspace_hash(raw_json) -> Column:
    """First workspace hash in a response body, null when there is none."""
    return F.nullif(F.regexp_extract(col(raw_json), WORKSPACE_IN_URL, 1), F.lit(""))


def rewrite_keys(text, targets, new_workspace=None, symmetric: bool = False) -> Column:
    """Replace each key that ``targets`` (map of normal key -> new key) knows, in one pass.

    A rewritten URL of the form https://host/public/team/{workspace}/attachment/{key}/name also takes
    ``new_workspace``. ``symmetric`` rewrites the plural path and dashed keys too, as harvested.
    """
    t, m = col(text), col(targets)
    path, key = ("/attachments?/", ANY_KEY) if symmetric else ("/attachment/", HEX_KEY)
    lead = f"(?i)^({key})(?=/)"
    follows = f"{lead}/[^)]"
    ws = None if new_workspace is None else (
        new_workspace if isinstance(new_workspace, Column) else F.lit(new_workspace))
    tail = rf"(?i)(https://[^/]+/public/team/){HEX_KEY}({path})$"

    def piece(p, i):
        found = F.when(i > 0, F.regexp_extract(p, lead, 1))
        return F.struct(p.alias("text"), F.length(found).alias("n"), F.try_element_at(m, normal_key(found)).alias("new"))

    def join(pieces):
        def one(x, i):
            body = F.when(x["new"].isNotNull(), F.concat(x["new"], F.substring(x["text"], x["n"] + 1, F.length(x["text"])))
                          ).otherwise(x["text"])
            if ws is None:
                return body
            nxt = F.get(pieces, i + 1)
            full = nxt["new"].isNotNull() & nxt["text"].rlike(follows) & ws.isNotNull()
            return F.when(full, F.regexp_replace(body, F.lit(tail), F.concat(F.lit("$1"), ws, F.lit("$2")))).otherwise(body)

        return F.array_join(F.transform(pieces, one), "")

    split = F.transform(F.split(t, f"(?i)(?<={path})(?={key}/)"), piece)
    idle = m.isNull() | (F.size(m) == 0) | ~t.rlike(f"(?i){path}{key}/")
    return F.when(idle, t).otherwise(let(split, join))


def split_name(full_name, email=None) -> tuple[Column, Column]:
    """(first, rest) at the first white space; a blank name takes the email's local part."""
    words = F.split(F.regexp_replace(col(full_name), r"^\s+|\s+$", ""), r"\s+", 2)
    first = F.nullif(F.get(words, F.lit(0)), F.lit(""))
    if email is not None:
        first = F.coalesce(first, F.substring_index(col(email), "@", 1))
    return F.coalesce(first, F.lit("")), F.coalesce(F.get(words, F.lit(1)), F.lit(""))


def display_label(formatted, given, family) -> Column:
    """Formatted name, else given and family, else a dash."""
    both = non_blank(F.concat_ws(" ", non_blank(given), non_blank(family)))
    return F.coalesce(non_blank(formatted), both, F.lit("—"))


def display_line(email, formatted, given, family, active) -> Column:
    """One line per user, inactive users marked."""
    return F.concat(
        F.lit("  - "), F.coalesce(F.trim(col(email)), F.lit("")), F.lit("  |  "),
        display_label(formatted, given, family),
        F.when(F.coalesce(col(active), F.lit(True)), F.lit("")).otherwise(F.lit(" (inactive)")),
    )


def _numbered(c) -> Column:
    return F.concat(F.lit("Automated Test "), col(c).try_cast("bigint").cast("string"))


def own_title(own_titles, case, case_id, row_id) -> Column:
    """What `result_title` finds in the row itself; null when there is nothing."""
    return F.coalesce(
        first_non_blank(*own_titles),
        pick(case, "title", "Title", "name", "Name") if case is not None else F.lit(None).cast("string"),
        _numbered(case_id), _numbered(row_id))


def titled(own, target_id, row_hash) -> Column:
    """``own`` title (`own_title`), else `Automated Test {key}` (fixed value)."""
    return F.coalesce(
        col(own), _numbered(target_id),
        F.concat(F.lit("Automated Test "), F.left(non_blank(row_hash), F.lit(12))),
        F.lit("Automated Test"),
    )


def result_title(own_titles, case, case_id, row_id, target_id, row_hash) -> Column:
    """Own title aliases, else the nested case's title, else `Automated Test {key}` (fixed value)."""
    return titled(own_title(own_titles, case, case_id, row_id), target_id, row_hash)


def join_message(*parts) -> Column:
    """Non-empty parts joined by a blank line; null when nothing is left."""
    joined = F.concat_ws("\n\n", *[F.nullif(col(p), F.lit("")) for p in parts])
    return F.when(F.trim(joined) != "", joined)


def step_comment(actual, comment) -> Column:
    """Markdown of a step: actual result, then comment."""
    # The two headings.
    return F.nullif(F.concat_ws(
        "\n\n",
        F.concat(F.lit("**Actual result**\n"), non_blank(actual)),
        F.concat(F.lit("**Comment**\n"), non_blank(comment)),
    ), F.lit(""))


def standalone_description(case_id, row_hash) -> Column:
    """Lines kept on a result whose case has no target."""
    # The wording of the three lines.
    return F.concat_ws(
        "\n",
        F.lit("Imported by workspace migration (no mapped test case on target)."),
        F.concat(F.lit("Source case_id: "), col(case_id).cast("string")),
        F.concat(F.lit("Source result hash: "), F.nullif(col(row_hash), F.lit(""))),
    )


def file_name(url, key) -> Column:
    """Last path segment of the URL, else `attachment_{first 8}.bin`."""
    path = F.regexp_extract(col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    last = F.nullif(F.regexp_extract(path, r"([^/]+)$", 1), F.lit(""))
    return F.coalesce(last, F.concat(F.lit("attachment_"), F.left(col(key), F.lit(8)), F.lit(".bin")))


def row_identity(row_hash, signature, target_case_id, params) -> tuple[Column, Column]:
    """(id, signature): the hash, and an existing signature or `{case|none}[:k=v|..][:hash]`."""
    row_id = non_blank(row_hash)
    case = F.coalesce(col(target_case_id).cast("string"), F.lit("none"))
    has_params = F.coalesce(F.size(params) > 0, F.lit(False))
    built = F.when(has_params | row_id.isNotNull(),
                   F.concat_ws(":", case, F.when(has_params, joined_entries(params)), row_id))
    return row_id, F.coalesce(non_blank(signature), built)


def suite_path(suite_title, suite, suites) -> Column:
    """Root-to-leaf titles: split title text, else the suite's title, else titles of `suites`."""
    listed = F.filter(F.transform(F.split(col(suite_title), r"[\t\n\r]+"), lambda x: F.trim(x)), lambda x: x != "")
    single = pick(suite, "title", "Title", "name", "Name")

    def one(s):
        return F.when(is_object(s), pick(s, "title", "Title", "name", "Name")).when(
            is_text(s), non_blank(as_text(s)))

    many = F.filter(F.transform(items(suites), one), lambda x: x.isNotNull())
    return F.coalesce(F.when(F.size(listed) > 0, listed), F.when(single.isNotNull(), F.array(single)),
                      F.when(F.size(many) > 0, many))


def short_titles(titles, n: int = 500) -> Column:
    """Trimmed, blanks dropped, long ones cut to ``n`` with an ellipsis."""
    kept = F.filter(F.transform(col(titles), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(
        kept, lambda x: F.when(F.length(x) > n, F.concat(F.left(x, F.lit(n - 3)), F.lit("..."))).otherwise(x))


def suite_title(title, name, row_id) -> Column:
    """Title, else name, else `Suite {id}`."""
    return F.coalesce(F.nullif(col(title), F.lit("")), F.nullif(col(name), F.lit("")),
                      F.concat(F.lit("Suite "), col(row_id).cast("string")))


# Where an attachment-like item may hold its key or its URL.
KEY_ALIASES = ("hash", "attachment_hash", "attachmentHash", "file_hash", "fileHash", "uuid", "UUID", "id")
URL_ALIASES = ("url", "URL", "link", "href", "thumb_url", "thumbnail_url", "preview_url", "src", "file_url")


def item_refs(item) -> Column:
    """array<struct<key,url>> of one attachment-like item: a key or URL, or an object of aliases."""
    nothing = none_of("array<struct<key:string,url:string>>")

    def listed(m, aliases):
        return F.transform(names(aliases), lambda a: as_text(F.try_element_at(m, a)))

    def bare(values):
        return F.transform(F.filter(values, looks_like_key), lambda v: F.struct(
            normal_key(v).alias("key"), F.lit(None).cast("string").alias("url")))

    def in_urls(values, keep_url):
        return F.transform(values, lambda u: F.struct(
            key_of_url(u).alias("key"), (u if keep_url else F.lit(None).cast("string")).alias("url")))

    alone = F.array(as_text(item))
    of_text = F.concat(bare(alone), in_urls(alone, False))
    of_object = let(members(item), lambda m: F.concat(
        bare(listed(m, KEY_ALIASES)), in_urls(listed(m, URL_ALIASES), True)))
    found = F.when(is_object(item), of_object).when(is_text(item), of_text).otherwise(nothing)
    return F.filter(found, lambda r: r["key"].isNotNull())


def media_refs(*lists) -> Column:
    """Refs of every item of several attachment-like lists."""
    return F.flatten(F.transform(F.flatten(F.array(*[items(v) for v in lists])), item_refs))


def media_keys(*lists) -> Column:
    """Distinct normal keys of several attachment-like lists, in order."""
    return F.array_distinct(F.transform(media_refs(*lists), lambda r: r["key"]))


def union_media(*lists) -> Column:
    """Ordered union of media lists, distinct by value, items as JSON text."""
    texts = [F.transform(items(v), lambda i: F.when(is_text(i), as_text(i)).otherwise(F.to_json(i)))
             for v in lists]
    return F.array_distinct(F.flatten(F.array(*texts)))


def packed(c) -> Column:
    """A text as bytes for a shuffle: a digest in lower hex digits takes half its length. Equal texts give equal bytes, and only they."""
    c = col(c)
    raw = F.unhex(c)
    return F.when(F.lower(F.hex(raw)) == c, F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))


def unpacked(c) -> Column:
    """The text that `packed` made bytes of."""
    c = col(c)
    rest = F.substring(c, 2, 0x7FFFFFFF)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
