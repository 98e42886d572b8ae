"""Fill-in-middle transformation over indexable skip lists.

A text is a sequence of units (code points, or matches of a pattern).  Two cut
ranks, counted in units, part it into prefix, middle and suffix, which are put
together behind marks: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle (psm), or
suffix first (spm).

The units of a text form a skip list.  The lowest lane links each unit to the
next; a lane above keeps one node in about ``SPREAD`` of the lane below.  Every
link carries two widths: the units and the code points that it passes.  A search
for a rank starts at the head of the highest lane, follows a link while the
units passed so far and its unit width stay within the rank, adds both widths,
and goes down where it would pass the rank.  On the lowest lane it stands at the
rank exactly, and the code points added up are the place to cut, whatever the
units' widths.  A search takes about SPREAD steps a lane; lanes are arrays, built
in one pass each, of about n / SPREAD nodes above the lowest one.

Everything is map-only: rows go through in slices of bounded size, and a text's
list lives only while the text is cut.  Which texts are cut, where and in which
form are columns, so draws are reproducible expressions of the row.

A text that holds one of the marks must stay plain, so that ``restore`` gets
every text back exactly from output and form: it splits the output at the marks.
No mark may overlap itself or another one, which is checked.

Defined results: a null text counts as empty; an empty text is plain; cut ranks
are taken modulo n + 1, null ranks count as 0, a null choice as no; extra
columns travel in the struct column ``row``; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import extended

MARKS = ("<P>", "<S>", "<M>")
SPREAD = 16
SEED = 12
SLICE_BYTES = 8 << 20


def unit_widths(text: str, unit: str | None) -> np.ndarray:
    """Code points of each unit: one each, or those from one match of the pattern to the next.

    What stands ahead of the first match belongs to the first unit; a text
    without a match is one unit.
    """
    if unit is None:
        return np.ones(len(text), np.uint8)
    starts = [m.start() for m in regex.finditer(unit, text) if m.end() > m.start()]
    if text:
        starts[:1] = [0]
    return np.diff([*starts, len(text)])


class SkipList:
    """Lanes of links, lowest first: units and code points passed, and the node below each link's start."""

    def __init__(self, widths: np.ndarray):
        self.length = len(widths)
        self.lanes = [(None, widths, None)]
        draw = np.random.Generator(np.random.Philox(key=[SEED, self.length]))
        units, chars = None, widths
        while len(chars) > SPREAD:
            gaps = draw.geometric(1 / SPREAD, 8 + 2 * len(chars) // SPREAD)
            nodes = np.cumsum(gaps)
            while nodes[-1] < len(chars):
                nodes = np.concatenate([nodes, nodes[-1] + np.cumsum(draw.geometric(1 / SPREAD, 8 + len(chars) // SPREAD))])
            nodes = np.concatenate([[0], nodes[:np.searchsorted(nodes, len(chars))]])
            passed = np.diff(nodes, append=len(chars)) if units is None else np.add.reduceat(units, nodes)
            chars = np.add.reduceat(chars, nodes, dtype=np.int64)
            units = passed
            self.lanes.append((units, chars, nodes))

    def seek(self, rank: int) -> int:
        """Code points ahead of the unit with this rank (0 to the number of units)."""
        at = units = chars = 0
        for passes, widths, below in reversed(self.lanes):
            while at < len(widths):
                onward = units + (1 if passes is None else int(passes[at]))
                if onward > rank:
                    break
                units, chars, at = onward, chars + int(widths[at]), at + 1
            if below is not None:
                at = int(below[at]) if at < len(below) else len(self.lanes[0][1])
                if at == len(self.lanes[0][1]):
                    break
        return chars


def check_marks(marks: tuple[str, str, str]) -> None:
    """No mark may stand in another one, or end as a mark begins: then the first match at a joint is the mark itself."""
    for a in marks:
        for b in marks:
            if not a or (a != b and a in b) or any(a.endswith(b[:k]) for k in range(1, len(b) + (a != b))):
                raise ValueError(f"marks {marks} overlap")


def fill_in_middle(docs: DataFrame, first: Column, second: Column, plain: Column, spm: Column, text_col: str = "text",
                   unit: str | None = None, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output) of every row.

    ``first`` and ``second`` are the cut ranks before the modulo, ``plain`` and
    ``spm`` choose the form; all are expressions over the columns of ``docs``.
    """
    check_marks(marks)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    held = F.lit(False)
    for mark in marks:
        held = held | F.contains(text, F.lit(mark))
    form = F.when((text == "") | held | F.coalesce(plain, F.lit(False)), "plain").when(
        F.coalesce(spm, F.lit(False)), "spm").otherwise("psm")
    drawn = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), form.alias("form"),
                        F.coalesce(first.cast("long"), F.lit(0)).alias("first"),
                        F.coalesce(second.cast("long"), F.lit(0)).alias("second"))
    pre, suf, mid = marks

    def cut(whole: str, how: str, a: int, b: int) -> tuple:
        widths = unit_widths(whole, unit)
        n = len(widths)
        if how == "plain":
            return n, None, None, whole
        units = SkipList(widths)
        x, y = sorted((a % (n + 1), b % (n + 1)))
        x, y = units.seek(x), units.seek(y)
        if how == "psm":
            return n, x, y - x, f"{pre}{whole[:x]}{suf}{whole[y:]}{mid}{whole[x:y]}"
        return n, x, y - x, f"{suf}{whole[y:]}{pre}{whole[:x]}{mid}{whole[x:y]}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("row").field(text_col)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < b.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES)))
                part = b.slice(at, stop - at)
                at = stop
                done = [cut(t or "", *r) for t, *r in zip(part.column("row").field(text_col).to_pylist(), *[
                    part.column(c).to_pylist() for c in ("form", "first", "second")])]
                n, x, y, output = zip(*done)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(n, pa.int64()), part.column("form"), pa.array(x, pa.int64()),
                     pa.array(y, pa.int64()), pa.array(output, pa.string())],
                    names=["row", "n", "form", "prefix_chars", "middle_chars", "output"])

    return drawn.mapInArrow(run, extended(drawn.select("row"),
                                          "n long, form string, prefix_chars long, middle_chars long, output string"))


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in marks), -1)
    one, two, three = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)
