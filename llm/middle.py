"""Fill-in-the-middle training texts, cut and reordered by a pyarrow.compute pipeline.

A text is a sequence of units: a word with the white space before it, or the white space that ends the text.  Two hashes
of the document's id choose two cuts between units; a third says whether the text is reordered at all, a fourth in which
form.  ``psm`` writes prefix, suffix, middle, each after its marker, ``spm`` suffix, prefix, middle.

Each batch is a few array operations without a loop over rows: the regular expression ends each unit with the byte 0xFF,
which UTF-8 never holds, and the split at it gives one list of units per row; the lists are flattened with the index of
their row, the ordinal of a unit is its place less the first place of its row, comparing ordinals with the cuts gives its
role, each role's units are filtered and put back into one list per row, and ``binary_join`` makes the three pieces.
Batches are cut into slices of bounded bytes first, so memory follows the longest text.  Rows never meet: nothing is
shuffled, and a lost task is run again with the same hashes.

Defined cases: NULL text is empty; an empty text, or one that already holds a marker, stays plain; a NULL id is hashed
as the empty string; repeated rows give equal rows; an empty table gives an empty table; columns other than ``doc_id``
and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import pieces

SEED = 42
RATE = 50  # percent of the texts that are reordered
SPM = 80  # percent of those in the form suffix, prefix, middle
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_BYTES = pa.large_binary()


def _bytes(text: str) -> pa.Scalar:
    return pa.scalar(text.encode(), _BYTES)


def _modulo(a, n):
    return pc.subtract(a, pc.multiply(pc.divide(a, n), n))


def _joined(units: pa.Array, counts: pa.Array) -> pa.Array:
    """One value per row from the units of all rows, of which row ``i`` has ``counts[i]``."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, units), _bytes(""))


def _cut(batch: pa.RecordBatch, rate: int, spm: int) -> pa.RecordBatch:
    text = pc.fill_null(batch["text"].cast(pa.large_string()), "")
    split = pc.split_pattern(pc.replace_substring_regex(text.cast(_BYTES), UNIT, b"\\0\xff"), b"\xff")
    n = pc.subtract(pc.list_value_length(split).cast(pa.int64()), 1)  # what follows the last end is no unit
    unit, row = pc.list_flatten(split), pc.list_parent_indices(split)
    ordinal = pc.subtract(pa.array(np.arange(len(unit))), split.offsets.cast(pa.int64()).take(row))
    ends = pc.add(n, 1)
    one, two = _modulo(batch["h1"], ends), _modulo(batch["h2"], ends)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    in_prefix = pc.less(ordinal, low.take(row))
    in_suffix = pc.and_(pc.greater_equal(ordinal, high.take(row)), pc.less(ordinal, n.take(row)))
    in_middle = pc.and_not(pc.less(ordinal, high.take(row)), in_prefix)
    prefix = _joined(unit.filter(in_prefix), low)
    middle = _joined(unit.filter(in_middle), pc.subtract(high, low))
    suffix = _joined(unit.filter(in_suffix), pc.subtract(n, high))
    marked = pc.match_substring_regex(text, MARKER)
    plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(_modulo(batch["h3"], 100), rate))
    suffix_first = pc.less(_modulo(batch["h4"], 100), spm)
    p, s, m, none = _bytes(PREFIX), _bytes(SUFFIX), _bytes(MIDDLE), _bytes("")
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)
    output = pc.if_else(suffix_first, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none), psm)
    missing = pa.scalar(None, pa.int64())

    def chars(piece: pa.Array) -> pa.Array:
        return pc.if_else(plain, missing, pc.utf8_length(piece.cast(pa.large_string())).cast(pa.int64()))

    return pa.record_batch(
        {
            "doc_id": batch["doc_id"],
            "n": n,
            "form": pc.if_else(plain, "plain", pc.if_else(suffix_first, "spm", "psm")),
            "prefix_chars": chars(prefix),
            "middle_chars": chars(middle),
            "output": pc.if_else(plain, text.cast(_BYTES), output).cast(pa.large_string()).cast(pa.string()),
        }
    )


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` per document: ``n`` units, and the text to train on."""
    doc_id = F.col("doc_id").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    hashed = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"), *numbers)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in pieces(batches):
            yield _cut(batch, rate, spm)

    return hashed.mapInArrow(cut, _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text before it was reordered; no piece holds a marker, so the markers cut the output where it was joined."""
    part = F.split(output, MARKER, -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )


def op13(docs: DataFrame) -> DataFrame:
    made = fill_in_middle(docs)
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
numbers AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM texts),
cut AS (
  SELECT doc_id, n, form, t, array_to_string(u[:least(a, b)], '') AS p,
    array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s
  FROM numbers)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""
