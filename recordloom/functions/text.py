"""Text and its inverted index (word -> positions)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .identifiers import _col, let

# Every occurrence as one number, position above the place of its word in the
# index, so that the sort compares numbers and not structs.
_PLACED = """e -> struct(e AS words, sort_array(flatten(transform(e, (w, i) ->
    transform(w.value, p -> shiftleft(bigint(p), 32) + i)))) AS at)"""

# Of several words at one position the last one stays.
_LAST_PER_POSITION = """r -> struct(r.words AS words, filter(r.at, (x, i) ->
    coalesce(shiftright(get(r.at, i + 1), 32) != shiftright(x, 32), true)) AS at)"""

_JOINED = """r -> array_join(transform(r.at, (x, i) ->
    repeat('- ', int(shiftright(x, 32) - coalesce(shiftright(get(r.at, i - 1), 32), -1L)) - 1)
    || get(r.words, int(x & 4294967295L)).key), ' ')"""

_PAIRS = "t -> sort_array(transform(t, (w, i) -> struct(w AS word, i AS pos)))"

# Where each distinct word starts in the sorted pairs, then its run of positions.
_STARTS = """s -> struct(s AS pairs, filter(
    CASE WHEN size(s) > 0 THEN sequence(0, size(s) - 1) ELSE array() END,
    i -> i = 0 OR get(s, i - 1).word != get(s, i).word) AS starts)"""
_RUNS = """c -> map_from_entries(transform(c.starts, (at, k) -> struct(
    get(c.pairs, at).word AS key,
    transform(sequence(at, coalesce(get(c.starts, k + 1), size(c.pairs)) - 1),
              j -> get(c.pairs, j).pos) AS value)))"""


def max_position(index: Column | str) -> Column:
    """Highest position in an inverted index."""
    return F.array_max(F.flatten(F.map_values(_col(index))))


def rebuild_text(index: Column | str) -> Column:
    """Text of an inverted index; gaps become ``-``, a later word wins a position.

    One sort of the positions per row, then linear passes, so long texts cost
    n log n and stay inside the row: nothing is exploded or shuffled.
    """
    placed = let(F.map_entries(_col(index)), _PLACED)
    return F.coalesce(let(let(placed, _LAST_PER_POSITION), _JOINED), F.lit(""))


def invert_text(words: Column | str) -> Column:
    """Inverted index of a list of words, by one sort and its runs."""
    return let(let(let(_col(words), _PAIRS), _STARTS), _RUNS)
