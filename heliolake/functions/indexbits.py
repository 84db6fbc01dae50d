"""Bits of the public hexagonal index: resolution, base cell, digits, parents, text, validity.

An identifier holds, from the top, a reserved bit, four bits of mode (1 for cells), three reserved bits, four of
resolution, seven of base cell and three for each of fifteen digits; digits beyond the resolution are 7. All functions are JVM expressions on
longs. From position to cell and back isn't here: that needs the index's own tables of faces and
base cells, which this library doesn't hold.

Defined results: null in, null out; what is no cell has no parent and no text is checked before it is read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number of base cells, and those that are pentagons.
BASE_CELLS = 122
PENTAGONS = (4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117)


def _bits(cell: Column, at: int, n: int) -> Column:
    return F.shiftrightunsigned(cell, at).bitwiseAND(F.lit((1 << n) - 1)).cast("int")


def resolution(cell: Column) -> Column:
    return _bits(cell, 52, 4)


def base_cell(cell: Column) -> Column:
    return _bits(cell, 45, 7)


def digit(cell: Column, level: int) -> Column:
    """Child digit of a level from 1 to 15; 7 beyond the cell's resolution."""
    return _bits(cell, 3 * (15 - level), 3)


def is_pentagon(cell: Column) -> Column:
    zeros = F.lit(True)
    for k in range(1, 16):
        zeros = zeros & (digit(cell, k).isin(0, 7))
    return base_cell(cell).isin(*PENTAGONS) & zeros


def is_valid(cell: Column) -> Column:
    """Mode, reserved bits, base cell and digits are those of a cell."""
    ok = (_bits(cell, 59, 5) == 1) & (_bits(cell, 56, 3) == 0) & (base_cell(cell) < BASE_CELLS)
    res = resolution(cell)
    first = F.lit(0)
    for k in range(15, 0, -1):
        ok = ok & F.when(res >= k, digit(cell, k) < 7).otherwise(digit(cell, k) == 7)
        # the first digit that isn't 0: a pentagon has no child in direction 1
        first = F.when((res >= k) & (digit(cell, k) != 0), digit(cell, k)).otherwise(first)
    return ok & ~(base_cell(cell).isin(*PENTAGONS) & (first == 1))


def parent(cell: Column, level: int) -> Column:
    """The cell of a coarser resolution that holds a cell; null for finer ones."""
    below = (1 << (3 * (15 - level))) - 1
    moved = cell.bitwiseAND(F.lit(~(15 << 52))).bitwiseOR(F.lit(level << 52)).bitwiseOR(F.lit(below))
    return F.when(resolution(cell) >= level, moved)


def center_child(cell: Column, level: int) -> Column:
    """The cell of a finer resolution at the centre of a cell; null for coarser ones."""
    res, out = resolution(cell), cell.bitwiseAND(F.lit(~(15 << 52))).bitwiseOR(F.lit(level << 52))
    for k in range(1, level + 1):
        out = F.when(res < k, out.bitwiseAND(F.lit(~(7 << (3 * (15 - k)))))).otherwise(out)
    return F.when(res <= level, out)


def to_text(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def from_text(text: Column) -> Column:
    """Cell of a hexadecimal text; null for anything else."""
    return F.when(text.rlike("^[0-9a-fA-F]{15,16}$"), F.conv(text, 16, 10).try_cast("bigint"))
