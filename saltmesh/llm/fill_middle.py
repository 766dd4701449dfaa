"""Fill-in-the-middle by a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that never change, its UTF-8 text and the
sentinels. Cutting splits descriptors, an arrangement permutes them, the inverse permutation restores them, and hashes run
over what the descriptors name, piece by piece; no text is copied for any of these.

Null and empty texts, and texts that hold a sentinel, stay plain; so do those whose draw is beyond the rate. A null id is
drawn as `seed:` alone. Rows that repeat are rows of their own with equal values, an empty table gives an empty one, and
other columns are not read, whatever their names. A text is one row of one Arrow batch, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import bounded_batches, keep_only, table

SEED = 7
#: Per cent of the documents that are arranged, and of these with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
#: Before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Places of (prefix, middle, suffix, sentinel of the prefix, of the suffix, of the middle) in the output of each form.
ARRANGEMENTS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
PLAIN = "plain"
TEXT, MARKS = 0, 1
PIECES = "array<struct<buffer:int,start:bigint,length:bigint>>"


class PieceTable:
    """Descriptors over an immutable text and the immutable sentinels."""

    def __init__(self, text: bytes, marks: bytes = b""):
        self.buffers = (memoryview(text), memoryview(marks))
        self.pieces: list[tuple[int, int, int]] = [(TEXT, 0, len(text))]

    def cut(self, places: Sequence[int]) -> None:
        """Splits the descriptors at these places of the content, in rising order; equal places leave empty pieces."""
        out, begin, at = [], 0, 0
        for buffer, start, length in self.pieces:
            end, done = begin + length, 0
            while at < len(places) and places[at] <= end:
                out.append((buffer, start + done, places[at] - begin - done))
                done, at = places[at] - begin, at + 1
            out.append((buffer, start + done, length - done))
            begin = end
        self.pieces = out

    def add_marks(self, lengths: Sequence[int]) -> None:
        """A descriptor for each sentinel, which stand one after another in their buffer."""
        start = 0
        for n in lengths:
            self.pieces.append((MARKS, start, n))
            start += n

    def permute(self, order: Sequence[int]) -> None:
        self.pieces = [self.pieces[k] for k in order]

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield self.buffers[buffer][start : start + length]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for piece in self.stream():
            h.update(piece)
        return h.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.stream())


def inverse(order: Sequence[int]) -> list[int]:
    out = [0] * len(order)
    for place, k in enumerate(order):
        out[k] = place
    return out


def line_ends(data: bytes) -> np.ndarray:
    """Where each line ends, with its newline; the last one may lack it. No byte of another character is a newline in UTF-8."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return ends if not data or data.endswith(b"\n") else np.append(ends, len(data))


def code_points(piece: memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(piece, np.uint8) & 0xC0) != 0x80))


def arranged(data: bytes, draws: Sequence[int], rate: int, suffix_first: int, marks: Sequence[bytes]) -> tuple[int, str, int | None, int | None, PieceTable]:
    """(lines, form, code points of prefix and middle, table) of a text."""
    ends, out = line_ends(data), PieceTable(data, b"".join(marks))
    n = len(ends)
    if not n or any(m in data for m in marks) or draws[2] % 100 >= rate:
        return n, PLAIN, None, None, out
    at = [0, *ends.tolist()]
    out.cut([at[k] for k in sorted((draws[0] % (n + 1), draws[1] % (n + 1)))])
    prefix, middle = (code_points(p) for _, p in zip(range(2), out.stream(), strict=False))
    form = "spm" if draws[3] % 100 < suffix_first else "psm"
    out.add_marks([len(m) for m in marks])
    out.permute(ARRANGEMENTS[form])
    return n, form, prefix, middle, out


def rebuilt(output: bytes, form: str, marks: Sequence[bytes]) -> PieceTable:
    """The text of an output, as descriptors over it: cut around its sentinels, then the inverse permutation."""
    out = PieceTable(output)
    if form == PLAIN:
        return out
    order = ARRANGEMENTS[form]
    places, begin = [], 0
    for k in (k for k in order if k >= 3):
        at = output.find(marks[k - 3], begin)
        if at < 0 or (not places and at):
            raise ValueError(f"not an output of the form {form}")
        begin = at + len(marks[k - 3])
        places += [at, begin]
    out.cut(places[1:])
    out.permute(inverse(order)[:3])
    return out


def arrange(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, sentinels: Sequence[str] = SENTINELS
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, pieces, output, output_sha256) for each row: its number of lines, how it is arranged, the descriptors of the output over the bytes of text (buffer 0) and sentinels (1), and the output.

    Cuts and form are drawn from the SHA-256 of `seed:id`, so they are the same whenever and wherever a row is read."""
    bounded_batches(docs.sparkSession)
    marks = [m.encode() for m in sentinels]
    key = F.col(id_col).cast("long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    draws = F.array(*(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)))
    rows = docs.select(key.alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), draws.alias("draws"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            cols: list[list] = [[] for _ in range(7)]
            for data, drawn in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("draws").to_pylist(), strict=True):
                n, form, prefix, middle, out = arranged(data, drawn, rate, suffix_first, marks)
                pieces = [{"buffer": b, "start": s, "length": k} for b, s, k in out.pieces]
                for col, value in zip(cols, (n, form, prefix, middle, pieces, out.content(), out.sha256()), strict=True):
                    col.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    descriptor = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(descriptor), pa.string(), pa.string()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"]
    schema = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, pieces {PIECES}, output string, output_sha256 string"
    return rows.mapInArrow(run, schema)


def restore(outputs: DataFrame, output_col: str = "output", form_col: str = "form", keep: Sequence[str] = (), sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """(text, restored_sha256, and the columns named in keep): the text again, from output and form alone. A null output is an empty one, a null form plain; an output that is not of its form is an error."""
    bounded_batches(outputs.sparkSession)
    marks = [m.encode() for m in sentinels]
    carried = [f"x_{k}" for k in range(len(keep))]
    rows = outputs.select(
        F.coalesce(F.col(output_col), F.lit("")).alias("output"), F.coalesce(F.col(form_col), F.lit(PLAIN)).alias("form"), *(F.col(c).alias(x) for c, x in zip(keep, carried, strict=True))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            text, sha = [], []
            for data, form in zip(batch.column("output").cast(pa.binary()).to_pylist(), batch.column("form").to_pylist(), strict=True):
                out = rebuilt(data, form, marks)
                text.append(out.content())
                sha.append(out.sha256())
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(sha, pa.string()), *(batch.column(x) for x in carried)], ["text", "restored_sha256", *carried])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = "text string, restored_sha256 string" + "".join(f", {x} {types[x]}" for x in carried)
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(carried, keep, strict=True)))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return restore(arrange(table(spark, sf_dir, "documents")), keep=columns).select(*columns, "restored_sha256")


OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    l AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
    p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
