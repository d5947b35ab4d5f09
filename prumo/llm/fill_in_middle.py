"""Fill-in-middle: texts cut at two random unit boundaries and rearranged, so that a model learns to write the middle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prumo.llm.common import _IS_SPACE, frugal, slices, text_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text in a chunk.
CHUNK = 1 << 14

#: Whether a unit starts at a byte, from the byte before it and the byte itself.
STARTS = {
    "char": lambda before, byte: (byte & 0xC0) != 0x80,
    "word": lambda before, byte: _IS_SPACE[before] & ~_IS_SPACE[byte],
    "line": lambda before, byte: before == 0x0A,
}


def cut_places(buf: np.ndarray, bounds: np.ndarray, draws: np.ndarray, unit: str, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of units of each text buf[bounds[i]:bounds[i + 1]], and for each row of draws the ranks (draw modulo number + 1,
    the smaller first) and the byte places that they stand for.

    Texts are cut into chunks of `chunk` bytes that overlap by the byte before them, so whether a unit starts at a byte is
    known inside the chunk. All chunks are counted at once; sums over the chunks before it give each chunk the ranks that
    it owns; and only the chunks that own one of the two ranks are scanned again, for its place. A text's first byte starts
    a unit; the rank after the last unit is the text's end.
    """
    starts_at = STARTS[unit]
    size = np.diff(bounds)
    per_text = -(-size // chunk)
    first_chunk = np.cumsum(per_text) - per_text
    text = np.repeat(np.arange(len(size)), per_text)
    begin = bounds[:-1][text] + chunk * (np.arange(len(text)) - first_chunk[text])
    end = np.minimum(begin + chunk, bounds[1:][text])
    if len(begin):
        flags = np.ones(len(buf), bool)
        flags[1:] = starts_at(buf[:-1], buf[1:])
        flags[bounds[:-1][size > 0]] = True
        counts = np.add.reduceat(flags, begin, dtype=np.int64)
    else:
        counts = np.zeros(0, np.int64)
    after = np.cumsum(counts)  # units up to the end of each chunk, of all texts
    base = np.r_[0, after][first_chunk]  # units before each text
    n = np.r_[0, after][first_chunk + per_text] - base
    ranks = np.sort(draws % (n[:, None] + 1), axis=1)
    places = np.where(ranks == n[:, None], bounds[1:, None], bounds[:-1, None])
    inner = np.argwhere((ranks > 0) & (ranks < n[:, None]))
    rank = base[inner[:, 0]] + ranks[inner[:, 0], inner[:, 1]]
    owner = np.searchsorted(after, rank, "right")
    for (row, which), c, left in zip(inner.tolist(), owner.tolist(), (rank - (after - counts)[owner]).tolist(), strict=True):
        a, b = int(begin[c]), int(end[c])
        at = max(a - 1, int(bounds[row]))  # the overlap, where the text has a byte before the chunk
        opens = starts_at(buf[at : b - 1], buf[at + 1 : b])
        found = np.flatnonzero(opens) + at + 1
        if at == a:
            found = np.r_[a, found]
        places[row, which] = found[left]
    return n, ranks, places


def _rearrange(unit: str, chunk: int):
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                buf, bounds = text_buffer(batch.column("text"))
                draws = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "second")], axis=1)
                n, ranks, places = cut_places(buf, bounds, draws, unit, chunk)
                data, out, forms = buf.tobytes(), [], batch.column("form").to_pylist()
                for form, a, z, (x, y) in zip(forms, bounds[:-1].tolist(), bounds[1:].tolist(), places.tolist(), strict=True):
                    if form == "psm":
                        out.append(b"".join((p, data[a:x], s, data[y:z], m, data[x:y])))
                    elif form == "spm":
                        out.append(b"".join((s, data[y:z], p, data[a:x], m, data[x:y])))
                    else:
                        out.append(data[a:z])
                none = np.array([f == "plain" for f in forms], bool)
                widths = (pa.array(w, pa.int64(), mask=none) for w in (ranks[:, 0], ranks[:, 1] - ranks[:, 0]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), batch.column("form"), *widths, pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "n", "form", "prefix_units", "middle_units", "output"])

    return frugal(run)


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, unit: str = "char", chunk: int = CHUNK) -> DataFrame:
    """doc_id, n (units), form, prefix_units, middle_units, output for every row of docs (doc_id, text and any others).

    Four draws come from the SHA-256 of seed and doc_id: two cut ranks, whether the text stays plain, and whether the suffix
    goes first (spm) or the prefix (psm). unit: char (code point), word or line, see STARTS. Texts that hold one of the three
    marks stay plain, so what was rearranged can always be taken apart again (see restore).

    There is no shuffle: each text is read once by one task, in numpy over the chunks of about a megabyte of texts at a time;
    memory is a few times the largest text. Null or empty text: plain, n = 0, empty output. Null doc_id: draws of the empty
    string. Rows that repeat a doc_id or a text are handled each by itself; equal ranks give an empty middle. An empty table
    gives no rows.
    """
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))).cast("binary"), 256)
    draw = [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (draw[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), form.alias("form"), draw[0].alias("first"), draw[1].alias("second"))
    return table.mapInArrow(_rearrange(unit, chunk), "doc_id long, n long, form string, prefix_units long, middle_units long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    prefix, suffix = (F.when(form == "psm", parts[a]).otherwise(parts[b]) for a, b in ((1, 2), (2, 1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def digest(docs: DataFrame) -> DataFrame:
    sha = [F.sha2(c.cast("binary"), 256) for c in (F.col("output"), restore(F.col("output"), F.col("form")))]
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), sha[0].alias("output_sha256"), sha[1].alias("restored_sha256"))


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (
  SELECT *, ('0x' || substring(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substring(h, 9, 8))::BIGINT % (n + 1) AS b,
         ('0x' || substring(h, 17, 8))::BIGINT % 100 AS p, ('0x' || substring(h, 25, 8))::BIGINT % 100 AS s FROM t),
f AS (
  SELECT *, least(a, b) AS x, greatest(a, b) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR p >= 90 THEN 'plain'
              WHEN s < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
g AS (
  SELECT *, substring(text, 1, x) AS pre, substring(text, x + 1, y - x) AS mid, substring(text, y + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars, CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM g
"""
