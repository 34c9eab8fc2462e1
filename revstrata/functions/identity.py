"""Identifiers of version-history objects as Column functions.

Identifiers are lower-case hex strings, whose order is the order of their bytes; NULL stands for "none".
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from revstrata.shipping import ship

NULL_ID = "0" * 40


def to_null(oid: Column) -> Column:
    """The identifier of nothing (all zeroes) as NULL."""
    return F.when(oid != NULL_ID, F.lower(oid))


def from_null(oid: Column) -> Column:
    return F.coalesce(oid, F.lit(NULL_ID))


def node_hash(p1: Column, p2: Column, data: Column) -> Column:
    """sha1 of the lesser parent, the greater parent and the content (binary or string)."""
    a, b = from_null(p1), from_null(p2)
    return F.sha1(F.concat(F.unhex(F.least(a, b)), F.unhex(F.greatest(a, b)), data.cast("binary")))


def node_of(p1: str | None, p2: str | None, data: bytes | None) -> str:
    """:func:`node_hash` of plain values, for use inside tasks; no content is empty content."""
    return hashlib.sha1(b"".join(sorted(bytes.fromhex(p or NULL_ID) for p in (p1, p2))) + (data or b"")).hexdigest()


def object_id(kind: Column, body: Column) -> Column:
    """sha1 of ``kind size NUL body``: the identifier of a blob, tree or commit."""
    raw = body.cast("binary")
    return F.sha1(F.concat(F.concat(kind, F.lit(" "), F.octet_length(raw).cast("string")).cast("binary"), F.unhex(F.lit("00")), raw))


def file_parents(node: Column, p1: Column, p2: Column, data: Column) -> Column:
    """The parents, as an array, under which a file's content has the hash ``node``; NULL if none do.

    Tried in order: both, the first, the second, the first twice, the second twice, none.
    """
    none = F.lit(None).cast("string")
    tries = [(p1, p2), (p1, none), (p2, none), (p1, p1), (p2, p2), (none, none)]
    out = F.lit(None).cast("array<string>")
    for a, b in reversed(tries):
        out = F.when(node_hash(a, b, data) == node, F.array_compact(F.array(a, b))).otherwise(out)
    return out


def abbreviates(prefix: Column, oid: Column) -> Column:
    """Whether ``prefix`` (any case, any number of nibbles) begins ``oid``."""
    return F.startswith(oid, F.lower(prefix))


def shared_prefix(a: Column, b: Column) -> Column:
    """How many leading nibbles two identifiers have in common; 0 with a NULL."""
    return F.coalesce(F.size(F.filter(F.sequence(F.lit(1), F.lit(40)), lambda k: F.substring(a, F.lit(1), k) == F.substring(b, F.lit(1), k))), F.lit(0))


ship(__name__)


def packed(oid: Column) -> Column:
    """A text as bytes, an identifier's digits as half as many; :func:`unpacked` gives the text again. Different texts have different bytes."""
    return F.when(oid.rlike(r"^[0-9a-f]{40}\z"), F.unhex(oid)).otherwise(F.concat(oid.cast("binary"), F.lit(bytes(21))))


def unpacked(raw: Column) -> Column:
    """The text that :func:`packed` made the bytes of."""
    n = F.octet_length(raw)
    return F.when(n == 20, F.lower(F.hex(raw))).otherwise(F.substring(raw, F.lit(1), n - 21).cast("string"))
