"""Fill-in-the-middle transformation: a text is cut at two of its units and its parts are put in another order.

A unit is a word with the blanks before it, or the blanks at the end. Units are counted once, ``EVERY`` at a time; after each
such stretch a checkpoint records the byte and the code-point offset. To cut at a unit, a binary search finds the last
checkpoint at or before it, and only from there to the cut the units are read again. So a long text has a small index, and
no list of its units is ever made.

Where the parts are cut, and whether and how they are ordered, follows from the SHA-256 of seed and doc_id, so reruns agree.
Forms: ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle), each part after its
mark. ``restored`` gives the text back from output and form.

Defined cases: null and empty texts have no unit and are plain and empty; texts that hold a mark are plain, so every output can
be restored; a text of blanks is one unit; rows that repeat a doc_id and text give equal rows; a null doc_id is hashed as an
empty number; texts are taken whole, of whatever length; other columns pass through in ``row``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sommelix.llm.common import per_text, table

#: Units between two checkpoints.
EVERY = 256
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: UTF-8 text. Blanks are single bytes, so bytes may be matched; nothing is given back once matched.
UNIT = rb"(?>[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"


class Checkpoints:
    """Units of a UTF-8 text, and where they end."""

    def __init__(self, data: bytes, every: int = EVERY):
        self.data, stretch, unit = data, *_patterns(every)
        self.units, self.bytes, self.chars = [0], [0], [0]
        at = chars = 0
        while found := stretch.match(data, at):
            chars += _chars(data[at : found.end()])
            at = found.end()
            self.units.append(self.units[-1] + every)
            self.bytes.append(at)
            self.chars.append(chars)
        self.n = self.units[-1] + len(unit.findall(data, at))
        self.unit = unit

    def end_of(self, units: int) -> tuple[int, int]:
        """Byte and code-point offset after so many units."""
        k = bisect_right(self.units, units) - 1
        at = self.bytes[k]
        for _ in range(units - self.units[k]):
            at = self.unit.match(self.data, at).end()
        return at, self.chars[k] + _chars(self.data[self.bytes[k] : at])


def _chars(data: bytes) -> int:
    return len(data.decode())


_compiled: dict[int, tuple[re.Pattern, re.Pattern]] = {}


def _patterns(every: int) -> tuple[re.Pattern, re.Pattern]:
    if every not in _compiled:
        _compiled[every] = re.compile(UNIT + b"{%d}" % every), re.compile(UNIT)
    return _compiled[every]


def transformed(doc_id: int | None, text: str | None, seed: int, rate: int, spm_rate: int, every: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    text = text or ""
    points = Checkpoints(text.encode(), every)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in MARKS) or h3 % 100 >= rate:
        return points.n, "plain", None, None, text
    (a, first), (b, second) = map(points.end_of, sorted((h1 % (points.n + 1), h2 % (points.n + 1))))
    prefix, middle, suffix = (points.data[s:e].decode() for s, e in ((0, a), (a, b), (b, None)))
    form = "spm" if h4 % 100 < spm_rate else "psm"
    parts = (SUFFIX, suffix, PREFIX, prefix) if form == "spm" else (PREFIX, prefix, SUFFIX, suffix)
    return points.n, form, first, second - first, "".join((*parts, MIDDLE, middle))


def filled_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, every: int = EVERY, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (the columns to keep, all unless named), n, form, prefix_chars, middle_chars and output of every document.

    ``rate`` of 100 texts are rearranged, ``spm_rate`` of 100 of those suffix first."""
    keep = tuple(docs.columns) if keep is None else keep
    # the id goes along with the text, so that both reach the same task
    paired = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.struct("doc_id", "text").alias("text"))

    def make():
        def work(pairs):
            made = [transformed(p["doc_id"], p["text"], seed, rate, spm_rate, every) for p in pairs]
            return list(zip(*made)) if made else [[]] * 5

        return work

    fields = {"n": ("bigint", pa.int64()), "form": ("string", pa.string()), "prefix_chars": ("bigint", pa.int64()), "middle_chars": ("bigint", pa.int64()), "output": ("string", pa.string())}
    out = per_text(paired, make, fields, ("kept",))
    return out.select(F.col("row.kept").alias("row"), *fields)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    parts = F.split(output, "<[PSM]>", -1)
    prefix, suffix = (F.when(form == "psm", F.get(parts, F.lit(a))).otherwise(F.get(parts, F.lit(b))) for a, b in ((1, 2), (2, 1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))


def op13_fill_in_middle(spark, sf_dir) -> DataFrame:
    made = filled_in_middle(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return made.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
  CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""
