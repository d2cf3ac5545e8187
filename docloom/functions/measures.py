"""Patterns over whole columns of texts at once, in Arrow: RE2 reads each text in time linear in its length, whatever the pattern.

Word boundaries, white space and digits are those of ASCII, as in the SQL of the queries; letters are Unicode's. A batch is read
a few megabytes at a time, so that what is derived from it stays small.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

OTHER_SPACE = r"[\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
IN_TOKEN = np.array([re.fullmatch("[A-Za-z0-9_]", chr(b)) is not None for b in range(256)])
PIECE = 4 << 20  # bytes of text that are read at once; one text is never divided


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The column in slices of about PIECE bytes."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PIECE, "right")))
        yield texts.slice(start, end - start)
        start = end


def over_pieces(kind: str, work: Callable[[pa.Array], pa.Array]):
    """A column function whose work sees a slice of texts at a time."""
    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            done = [work(x) for x in pieces(texts)]
            yield pa.concat_arrays(done) if done else work(texts)

    return run


def meeting(text: Column, patterns: dict[str, str]) -> Column:
    """The names of the patterns that a text meets, in their order; none for null."""
    def work(texts: pa.Array) -> pa.Array:
        met = np.stack([pc.match_substring_regex(texts, p).fill_null(False).to_numpy(zero_copy_only=False) for p in patterns.values()], axis=1)
        row, which = np.nonzero(met)
        offsets = np.concatenate(([0], np.cumsum(met.sum(axis=1)))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(list(patterns), pa.string()).take(pa.array(which)))

    return over_pieces("array<string>", work)(text)


def collapsed(texts: pa.Array) -> pa.Array:
    """White space (Unicode's) to single spaces, trimmed; texts that have no other are left as they are."""
    odd = pc.match_substring_regex(texts, rf"^ | $|  |{OTHER_SPACE}")
    if not pc.any(odd, min_count=0).as_py():
        return texts
    single = pc.utf8_trim(pc.replace_substring_regex(texts.filter(odd), f"(?: |{OTHER_SPACE})+", " "), " ")
    return pc.replace_with_mask(texts, odd, single)


def repeated(texts: pa.Array, most: int = 3, least: int = 8) -> np.ndarray:
    """How many tokens of up to `most` letters a-z (7 at most) each text has that come `least` times or more in it."""
    low = pc.utf8_lower(texts.cast(pa.string()))
    wide = pc.invert(pc.string_is_ascii(low))
    if pc.any(wide, min_count=0).as_py():  # from here on a byte is a character: other letters count as _, other marks as spaces
        narrow = pc.replace_substring_regex(pc.replace_substring_regex(low.filter(wide), r"[^\x00-\x7f\p{L}\p{N}]+", " "), r"[^\x00-\x7f]+", "_")
        low = pc.replace_with_mask(low, wide, narrow)
    offsets = np.frombuffer(low.buffers()[1], np.int32)[low.offset : low.offset + len(low) + 1]
    data = np.frombuffer(low.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside, edge = IN_TOKEN[data], np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    around = np.concatenate(([False], inside, [False]))
    starts = np.flatnonzero(inside & (~around[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside & (~around[2:] | edge[1:])) + 1
    few = ends - starts <= most
    starts, ends = starts[few], ends[few]
    codes, plain = np.zeros(len(starts), np.int64), np.ones(len(starts), bool)
    for k in range(most):
        there = starts + k < ends
        byte = data[np.where(there, starts + k, 0)].astype(np.int64)
        plain &= ~there | ((byte >= 97) & (byte <= 122))
        codes = codes * 32 + np.where(there, byte - 96, 0)
    rows = np.searchsorted(offsets, starts[plain], "right") - 1
    pairs, n = np.unique((rows << 5 * most) + codes[plain], return_counts=True)
    many = n >= least
    return np.bincount(pairs[many] >> 5 * most, weights=n[many], minlength=len(texts)).astype(np.int64)


def count(texts: pa.Array, pattern: str) -> pa.Array:
    """How often a pattern is met; letters and spaces are looked for as they are, which takes a seventh of the time for a space."""
    return (pc.count_substring if re.fullmatch(r"[A-Za-z ]+", pattern) else pc.count_substring_regex)(texts, pattern)


def measured(text: Column, patterns: dict[str, str], counted: dict[str, str], short: bool = False, clean: bool = False) -> Column:
    """A struct for each text (null counts as ''): patterns: whether it meets them; counted: how often; and, if asked, repeated.
    clean: all of these of the text with single spaces, and n_clean, its characters then."""
    names = [*patterns, *counted, *(["repeated"] if short else []), *(["n_clean"] if clean else [])]
    kind = ", ".join([*(f"{k}: boolean" for k in patterns), *(f"{k}: int" for k in names[len(patterns) :])])

    def work(texts: pa.Array) -> pa.Array:
        texts = collapsed(texts.fill_null("")) if clean else texts.fill_null("")
        columns = [pc.match_substring_regex(texts, p) for p in patterns.values()] + [count(texts, p).cast(pa.int32()) for p in counted.values()]
        if short:
            columns.append(pa.array(repeated(texts).astype(np.int32)))
        if clean:
            columns.append(pc.utf8_length(texts).cast(pa.int32()))
        return pa.StructArray.from_arrays(columns, names)

    return over_pieces(f"struct<{kind}>", work)(text)
