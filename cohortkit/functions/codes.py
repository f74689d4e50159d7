"""Code expressions (E1, E4, E5, E8): all JVM-side built-ins, no UDF."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_code(col: Column | str) -> Column:
    """Text, upper case, every character outside ``[A-Z0-9]`` removed ("G30.9" -> "G309")."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(F.upper(c.cast("string")), r"[^A-Z0-9]", "")


def padded_id(col: Column | str) -> Column:
    """A numeric patient id as text of at least seven digits; longer ids keep all theirs."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    return F.lpad(text, F.greatest(F.lit(7), F.length(text)), F.lit("0"))


def prefix_regex(prefixes: Iterable[str]) -> str:
    """Anchored alternation, longest prefix first; an empty list is an error."""
    escaped = sorted(set(re.escape(p) for p in prefixes if p), key=lambda s: (-len(s), s))
    if not escaped:
        raise ValueError("no diagnosis prefixes in the code maps")
    return "^(?:" + "|".join(escaped) + ")"


def trie_regex(prefixes: Iterable[str]) -> str:
    """An anchored pattern of the prefixes' tree. A code meets one branch at each character, so the time of a match follows
    the length of a code and the size of the alphabet, not the number of prefixes."""
    tree: dict = {}
    for p in sorted(set(prefixes), key=len):
        node = tree
        for ch in p:
            if node is None:  # a shorter prefix matches already
                break
            last, node = node, node.setdefault(ch, {})
        else:
            if node is not None:
                last[ch] = None

    def pattern(node: dict) -> str:
        ends = [re.escape(ch) for ch in sorted(node) if node[ch] is None]
        parts = (["[" + "".join(ends) + "]" if len(ends) > 1 else ends[0]] if ends else []) \
            + [re.escape(ch) + pattern(node[ch]) for ch in sorted(node) if node[ch] is not None]
        return "(?:" + "|".join(parts) + ")" if len(parts) > 1 else parts[0]

    return "^" + pattern(tree)


def mask_bits(groups: Iterable[str]) -> dict[str, int]:
    """Group -> its bit in a code mask."""
    return {g: 1 << i for i, g in enumerate(groups)}


def prefix_masks(groups: dict[str, Iterable[str]]) -> dict[str, int]:
    """Prefix -> bits of all groups that hold it or one of its beginnings; prefixes that add nothing to their longest
    beginning are left out, so a code's bits are those of the longest listed prefix it starts with."""
    bits, own = mask_bits(groups), {}
    for g, prefixes in groups.items():
        for p in prefixes:
            if p:
                own[p] = own.get(p, 0) | bits[g]
    out: dict[str, int] = {}
    for p in sorted(own, key=lambda p: (len(p), p)):
        above = next((out[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in out), 0)
        if own[p] | above != above:
            out[p] = own[p] | above
    return out


def code_mask(col: Column | str, groups: dict[str, Iterable[str]]) -> Column:
    """The groups a code belongs to by its beginning, as bits of one integer (0: none, or a null code).

    The beginnings of the code, longest first, are looked up in hashed literal sets, one per mask: the time follows the
    number of prefix lengths, not of prefixes. ``col`` is read several times; give a column, not a long expression.
    """
    c = F.col(col) if isinstance(col, str) else col
    sets: dict[tuple[int, int], list[str]] = {}
    for p, mask in prefix_masks(groups).items():
        sets.setdefault((len(p), mask), []).append(p)
    found = [F.when(F.substring(c, 1, length).isin(prefixes), F.lit(mask))
             for (length, mask), prefixes in sorted(sets.items(), key=lambda s: (-s[0][0], s[0][1]))]
    return F.coalesce(*found, F.lit(0))


def prefix_match(col: Column | str, prefixes: Iterable[str]) -> Column:
    """E5 / J6 (literal form): true when the code starts with any of ``prefixes``; false for a null
    code or an empty list.

    One anchored pattern (the prefixes' tree), so the code expression is evaluated once per row inside
    whole-stage codegen: no join, no shuffle, and the same form whatever the map holds.
    """
    c = F.col(col) if isinstance(col, str) else col
    plist = sorted(set(p for p in prefixes if p))
    return F.coalesce(c.rlike(trie_regex(plist)), F.lit(False)) if plist else F.lit(False)


def code_in(col: Column | str, codes: Iterable[str]) -> Column:
    """Exact set membership (F4, E12), ``false`` for an empty set or a null code."""
    c = F.col(col) if isinstance(col, str) else col
    vals = sorted(set(v for v in codes if v))
    if not vals:
        return F.lit(False)
    return F.coalesce(c.isin(vals), F.lit(False))


def class_lookup(col: Column | str, classes: dict[str, list[str]]) -> Column:
    """Code -> class as a ``CASE`` over per-class ``InSet``s; unmapped -> null."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for cls, codes in classes.items():
        if not codes:
            continue
        expr = (F.when(c.isin(codes), F.lit(cls)) if expr is None else expr.when(c.isin(codes), F.lit(cls)))
    return expr if expr is not None else F.lit(None).cast("string")
