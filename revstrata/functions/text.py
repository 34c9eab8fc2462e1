"""Text codecs of version-history records as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extra_map(extra: Column) -> Column:
    """``k:v`` entries joined by NUL as a map."""
    return F.str_to_map(extra, F.lit("\\x00"), F.lit(":"))


def extra_text(extra: Column) -> Column:
    """A map as ``k:v`` entries in order of their keys, joined by NUL."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(extra)), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), "\x00")


def extra_set(extra: Column, key: str, value: Column) -> Column:
    """``extra`` with ``key`` set to ``value``, or without it where that is NULL; NULL is an empty map."""
    held = F.coalesce(extra, F.create_map().cast("map<string,string>"))
    rest = F.map_filter(held, lambda k, _: k != key)
    return F.when(value.isNull(), rest).otherwise(F.map_concat(rest, F.create_map(F.lit(key), value)))


def branch_of(extra: Column) -> Column:
    return F.coalesce(extra["branch"], F.lit("default"))


def is_closed(extra: Column) -> Column:
    return F.coalesce(F.map_contains_key(extra, "close"), F.lit(False))


def percent_encode(text: Column) -> Column:
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def percent_decode(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def batch_escape(text: Column) -> Column:
    """``:``, ``,``, ``;`` and ``=`` as ``:c``, ``:o``, ``:s`` and ``:e``; the colon first."""
    for a, b in ((":", ":c"), (",", ":o"), (";", ":s"), ("=", ":e")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def batch_unescape(text: Column) -> Column:
    for a, b in (("=", ":e"), (";", ":s"), (",", ":o"), (":", ":c")):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def tree_path(path: Column) -> Column:
    """Every component of a path behind an underscore."""
    return F.regexp_replace(path, "(^|/)", "$1_")


def manifest_path(path: Column) -> Column:
    return F.regexp_replace(path, "(^|/)_", "$1")


def mode_attr(mode: Column) -> Column:
    """File modes as manifest attributes: ``x`` executable, ``l`` link, empty else."""
    kind, perms = mode.bitwiseAND(0o170000), mode.bitwiseAND(0o777)
    return F.when(kind == 0o120000, "l").when((kind == 0o100000) & (perms.bitwiseAND(0o100) != 0), "x").otherwise("")


def attr_mode(attr: Column) -> Column:
    return F.when(attr == "l", 0o120000).when(attr == "x", 0o100755).otherwise(0o100644)


def split_changeset(raw: Column) -> Column:
    """STRUCT(manifest, author, date, files, body) of ``manifest LF author LF date LF files... LF LF body``; NULL for lines that are not there."""
    head, body = F.substring_index(raw, "\n\n", 1), F.substring(raw, F.instr(raw, "\n\n") + 2, F.length(raw))
    lines = F.split(head, "\n")
    return F.struct(
        F.get(lines, F.lit(0)).alias("manifest"),
        F.get(lines, F.lit(1)).alias("author"),
        F.get(lines, F.lit(2)).alias("date"),
        F.slice(lines, F.lit(4), F.greatest(F.size(lines) - 3, F.lit(0))).alias("files"),
        body.alias("body"),
    )


def manifest_line(line: Column) -> Column:
    """STRUCT(path, file_node, attr) of ``path NUL 40 hex attr``."""
    rest = F.substring_index(line, "\x00", -1)
    return F.struct(F.substring_index(line, "\x00", 1).alias("path"), F.substring(rest, 1, 40).alias("file_node"), F.substring(rest, 41, 1).alias("attr"))


#: Labels that name something else.
RESERVED_LABELS = ("tip", ".", "null")


def bad_label(label: Column) -> Column:
    """Whether a label is reserved, all digits, edged by white space, empty, or holds a colon, NUL or line end."""
    return label.isin(*RESERVED_LABELS) | label.rlike(r"^[0-9]+$") | label.rlike(r"[:\x00\n\r]") | label.rlike(r"^[ \t\n\f\r]|[ \t\n\f\r]$") | (label == "")


def metadata_branches(url: Column) -> Column:
    """Names under which a repository's metadata may be kept, nearest first: the path's ends, growing to host and path, then ``metadata``."""
    parts = F.concat(F.array(F.regexp_extract(url, "^[a-z]+://(?:[^/@]*@)?([^/:?#]*)", 1)), F.split(F.regexp_extract(url, "^[a-z]+://[^/?#]*([^?#]*)", 1), "/"))
    found = F.filter(parts, lambda p: p != "")
    ends = F.transform(F.sequence(F.lit(1), F.size(found)), lambda k: F.array_join(F.slice(found, F.size(found) - k + 1, k), "/"))
    return F.concat(F.when(F.size(found) > 0, ends).otherwise(F.array().cast("array<string>")), F.array(F.lit("metadata")))


def encode_capabilities(names: Column) -> Column:
    """A map of capability to array of values (NULL: none) as ``name=v1,v2`` lines in order of names."""
    quoted = lambda x: F.replace(percent_encode(x), F.lit("%2F"), F.lit("/"))
    line = lambda e: F.concat(quoted(e["key"]), F.coalesce(F.concat(F.lit("="), F.array_join(F.transform(e["value"], quoted), ",")), F.lit("")))
    return F.array_join(F.transform(F.array_sort(F.map_entries(names)), line), "\n")


def decode_capabilities(lines: Column) -> Column:
    """``name[=v1,v2]`` lines as a map of name to array of values; NULL for names without ``=``."""
    value = lambda x: F.when(F.contains(x, F.lit("=")), F.transform(F.split(F.substring(x, F.instr(x, "=") + 1, F.length(x)), ","), percent_decode))
    entry = lambda x: F.struct(percent_decode(F.substring_index(x, "=", 1)).alias("key"), value(x).alias("value"))
    return F.map_from_entries(F.transform(F.filter(F.split(lines, "\n"), lambda x: x != ""), entry))


def split_exactly(text: Column, sign: str, n: int, from_end: bool = False) -> Column:
    """A text cut at ``sign`` into exactly ``n`` pieces, counted from either end, the last of them with what is left; NULL if it has fewer."""
    if not from_end:
        parts = F.split(text, r"\Q" + sign + r"\E", n)
        return F.when(F.size(parts) == n, parts)
    parts = F.split(text, r"\Q" + sign + r"\E", -1)
    first = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - (n - 1), F.lit(0))), sign)
    return F.when(F.size(parts) >= n, F.concat(F.array(first), F.slice(parts, F.greatest(F.size(parts) - (n - 2), F.lit(1)), F.lit(n - 1))) if n > 1 else F.array(first))


def plain_url(address: Column) -> Column:
    """The address behind ``hg::ADDRESS`` or ``hg://HOST[:[PORT.]SCHEME|:PORT]/...``; NULL for others.

    ``hg::`` before an absolute path makes a file address; without a scheme or port the scheme is https; ``hg://:tags`` is ``tags:``.
    """
    rest = F.substring(address, F.lit(5), F.length(address))
    direct = F.when(rest.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), rest).when(F.startswith(rest, F.lit("/")), F.concat(F.lit("file://"), rest))
    pattern = r"^hg://((?:\[[^\]]*\]|[^:/?#\[])*)(?::([^/?#]*))?(.*)$"
    host, word, tail = (F.regexp_extract(address, pattern, k) for k in (1, 2, 3))
    both = word.rlike("^[^.]*[.][^.]*$")
    port = F.when(both, F.substring_index(word, ".", 1)).when(word.rlike("^[0-9]+$"), word).otherwise("")
    scheme = F.when(both, F.substring_index(word, ".", -1)).when((word == "") | word.rlike("^[0-9]+$"), "https").otherwise(word)
    made = F.when((scheme == "tags") & (host == "") & (port == "") & (tail == ""), "tags:").otherwise(F.concat(scheme, F.lit("://"), host, F.when(port != "", F.concat(F.lit(":"), port)).otherwise(""), tail))
    return F.when(F.startswith(address, F.lit("hg::")), direct).when(F.startswith(address, F.lit("hg://")), made)


def clone_line(line: Column) -> Column:
    """STRUCT(url, branch, graft) of ``url[#branch] [graft=id,id]``; NULL for an empty line, an unknown or repeated parameter, or a bad identifier."""
    words = F.filter(F.split(line, r"[ \t]+"), lambda w: w != "")
    spec, params = F.try_element_at(words, F.lit(1)), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    sound = spec.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") & (F.size(params) <= 1) & F.forall(params, lambda p: p.rlike("^graft=[0-9a-f]{40}(,[0-9a-f]{40})*$"))
    graft = F.flatten(F.transform(params, lambda p: F.split(F.substring_index(p, "=", -1), ",")))
    branch = F.when(F.contains(spec, F.lit("#")), F.substring(spec, F.instr(spec, "#") + 1, F.length(spec)))
    return F.when(sound, F.struct(F.substring_index(spec, "#", 1).alias("url"), branch.alias("branch"), graft.alias("graft")))
