"""Fill-in-middle transformation over an indexable skip list of units.

A text is cut into units (``[A-Za-z]+|[^A-Za-z]``). Cuts are drawn as unit
ranks, texts are sliced by code points; the skip list maps one to the other. Its
nodes are the unit boundaries of a text. Every boundary has a height (hashed
from its rank, one in four is one lane higher); the lane of a height links the
boundaries that are at least so high. Each link carries two widths: units and
code points. A search starts at the text's head in the top lane, follows links
while the units passed stay within the rank, and goes down a lane when the next
link would pass it; in the lowest lane links are one unit wide, so it ends at
the rank exactly and the code points passed are the cut. The lists of all texts
of a slice are built and searched side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import canonical, documents, mixed, text_slices

#: Markers, and the percentages of whole texts and of suffix-first texts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
SEED = 1
#: One boundary in 2 ** LANE_BITS is a lane higher; no more lanes than LANES.
LANE_BITS, LANES = 2, 12

_CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class SkipLists:
    """The skip lists of a batch of texts."""

    def __init__(self, texts: pa.Array):
        chars = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        text_at = np.concatenate(([0], np.cumsum(lengths)))
        folded = chars | np.uint32(32)
        letter = (folded >= 97) & (folded <= 122) & (chars < 128)
        starts = np.ones(len(chars), dtype=bool)
        starts[1:] = ~(letter[1:] & letter[:-1])
        starts[text_at[:-1][lengths > 0]] = True
        unit_start = np.flatnonzero(starts)
        first = np.searchsorted(unit_start, text_at)
        self.units = np.diff(first)
        # boundaries: 0 ... units of every text, one text after another
        n = len(self.units)
        self.head = first[:-1] + np.arange(n)
        total = len(unit_start) + n
        at = np.empty(total, dtype=np.int64)
        inner = np.ones(total, dtype=bool)
        ends = self.head + self.units
        inner[ends] = False
        at[inner] = unit_start
        at[ends] = text_at[1:]
        rank = np.arange(total) - np.repeat(self.head, self.units + 1)
        height = self._heights(rank)
        owner = np.repeat(np.arange(n), self.units + 1)
        self.lanes = []
        node = below = np.arange(total)
        for lane in range(int(height[rank > 0].max(initial=0)) + 1):
            if lane:
                keep = (height[node] >= lane) | (rank[node] == 0)
                node = node[keep]
            same = np.append(owner[node][1:] == owner[node][:-1], False) if len(node) else np.zeros(0, dtype=bool)
            after = np.append(node[1:], 0) if len(node) else node
            self.lanes.append({
                "head": np.searchsorted(node, self.head), "linked": same,
                "units": np.where(same, rank[after] - rank[node], 0), "chars": np.where(same, at[after] - at[node], 0),
                "down": np.searchsorted(below, node)})
            below = node

    @staticmethod
    def _heights(rank: np.ndarray) -> np.ndarray:
        height = np.zeros(len(rank), dtype=np.int64)
        bits = mixed(rank.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        still = np.ones(len(rank), dtype=bool)
        for _ in range(LANES):
            still &= (bits & np.uint64((1 << LANE_BITS) - 1)) == 0
            if not still.any():
                break
            height += still
            bits >>= np.uint64(LANE_BITS)
        return height

    def chars_at(self, rank: np.ndarray) -> np.ndarray:
        """Code points before unit number ``rank`` (0 to the number of units) of each text."""
        units = np.zeros(len(rank), dtype=np.int64)
        chars = np.zeros(len(rank), dtype=np.int64)
        at = self.lanes[-1]["head"]
        for number in range(len(self.lanes) - 1, -1, -1):
            lane = self.lanes[number]
            while True:
                go = lane["linked"][at] & (units + lane["units"][at] <= rank)
                if not go.any():
                    break
                units = units + np.where(go, lane["units"][at], 0)
                chars = chars + np.where(go, lane["chars"][at], 0)
                at = at + go
            at = lane["down"][at]
        if not np.array_equal(units, rank):
            raise ValueError("a search did not end at its rank")
        return chars


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """h1 to h4: 8-digit groups of the sha256 of ``seed:doc_id`` (no id: nothing after the colon)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        texts = batch.column("text")
        lists = SkipLists(texts)
        h = [batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
        one, two = h[0] % (lists.units + 1), h[1] % (lists.units + 1)
        cuts = [lists.chars_at(c).tolist() for c in (np.minimum(one, two), np.maximum(one, two))]
        forms, outputs, prefixes, middles = [], [], [], []
        for text, a, b, whole, order in zip(texts.to_pylist(), *cuts, (h[2] % 100 >= PLAIN_FROM).tolist(), (h[3] % 100).tolist()):
            if not text or whole or PREFIX in text or SUFFIX in text or MIDDLE in text:
                forms.append("plain")
                outputs.append(text)
                prefixes.append(None)
                middles.append(None)
                continue
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            spm = order < SPM_BELOW
            forms.append("spm" if spm else "psm")
            outputs.append(SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle if spm
                           else PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle)
            prefixes.append(a)
            middles.append(b - a)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(lists.units), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()),
            pa.array(middles, pa.int64()), pa.array(outputs, pa.string())], names=[c.split()[0] for c in _CUT.split(", ")])


def fill_in_middle(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars and
    middle_chars (null in plain form), output.

    Null and empty texts have no unit and stay plain, as do texts that hold a
    marker; repeated rows are cut alike, equal texts by their ids; rows without
    doc_id share the draw of an empty id. An empty table gives an empty result;
    other input columns are ignored.
    """
    return (canonical(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
            .select("doc_id", "text", *_draws(F.col("doc_id"), seed)).mapInArrow(_cut, _CUT))


def restored(output: Column, form: Column) -> Column:
    """The text that a transformed one was made of. Texts in parts hold no
    marker, so the first of each marker is the one that was put in."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        a, b = F.instr(output, second), F.instr(output, MIDDLE)
        return (F.substring(output, F.lit(len(first) + 1), a - len(first) - 1),
                F.substring(output, a + len(second), b - a - len(second)), F.substring(output, b + len(MIDDLE), F.length(output)))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    text = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "psm", text).otherwise(F.concat(prefix, middle, suffix))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    return fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def _sql_draw(i: int) -> str:
    return f"('0x' || substr(sha256(concat('{SEED}:', coalesce(doc_id::VARCHAR, ''))), {8 * i + 1}, 8))::BIGINT"


ORACLE = f"""
WITH unit AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    {_sql_draw(0)} AS h1, {_sql_draw(1)} AS h2, {_sql_draw(2)} AS h3, {_sql_draw(3)} AS h4 FROM documents),
rank AS (SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM unit),
cut AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s,
    CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {PLAIN_FROM}
      THEN 'plain' WHEN h4 % 100 < {SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM rank)
SELECT doc_id, len(u)::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
    ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
