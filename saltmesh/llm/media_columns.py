"""Media columns: interleaved text and media sequences of HTML documents.

`interleave` parses HTML into ordered rows, text or media reference, with the caption that stands beside a reference.
`media_store` keeps each distinct payload once, by digest, in a stored form. `resolve` joins references to the store
by digest, so that positions and captions stay with their payloads.

The stored form is binary PGM: 64 samples of 8 bits to a line, so payloads are padded with zero bytes to a positive
multiple of 64.

Defined results: null or empty text gives a payload of 64 zero bytes and n_bytes 0. Equal texts share one stored row.
References without a stored payload resolve to null columns. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

LINE = 64
SCHEME = "sha256:"
SEQUENCE = "id long, position int, kind string, text string, media_digest string, caption string"
FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


class _Interleaver(HTMLParser):
    """Ordered items [kind, text, digest, caption]; a figcaption or an alt text is the caption of its reference."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[list] = []
        self.text: list[str] = []
        self.silent = 0
        self.caption: list[str] | None = None
        self.figure: int | None = None

    def flush(self) -> None:
        if (text := "".join(self.text)).strip():
            self.items.append(["text", text, None, None])
        self.text = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.silent += 1
        elif tag in ("img", "video", "audio", "source"):
            self.flush()
            given = dict(attrs)
            src = given.get("src") or ""
            self.items.append(["media", None, src.removeprefix(SCHEME) if src.startswith(SCHEME) else None, given.get("alt")])
        elif tag == "figure":
            self.flush()
            self.figure = len(self.items)
        elif tag == "figcaption":
            self.flush()
            self.caption = []
        elif tag in ("p", "div", "br", "li", "h1", "h2", "h3", "article", "td"):
            self.flush()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.silent = max(0, self.silent - 1)
        elif tag == "figcaption" and self.caption is not None:
            for item in self.items[self.figure or 0 :]:
                if item[0] == "media":
                    item[3] = "".join(self.caption).strip()
            self.caption = None
        elif tag == "figure":
            self.figure = None
        elif tag in ("p", "div", "li", "h1", "h2", "h3", "article", "td"):
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            (self.text if self.caption is None else self.caption).append(data)

    def done(self) -> list[list]:
        self.close()
        self.flush()
        return self.items


def interleave(pages: DataFrame, id_col: str, html_col: str, keep_text: bool = True) -> DataFrame:
    """Rows of SEQUENCE; position counts text and media items of a page from 0. Without keep_text, text rows carry no text."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parser = _Interleaver()
                parser.feed(html or "")
                out += [(i, at, kind, text if keep_text else None, digest, caption) for at, (kind, text, digest, caption) in enumerate(parser.done())]
            cols = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["id", "position", "kind", "text", "media_digest", "caption"])

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html")).mapInArrow(parse, SEQUENCE)


def padded(data: Column) -> Column:
    """Zero bytes appended up to a positive multiple of LINE."""
    full = F.greatest(F.ceil(F.length(data) / F.lit(LINE)) * LINE, F.lit(LINE)).cast("int")
    return F.rpad(data, full, F.lit(b"\x00"))


def to_media(payload: Column) -> Column:
    """The payload as binary PGM."""
    header = F.concat(F.lit(f"P5\n{LINE} "), (F.length(payload) / LINE).cast("int").cast("string"), F.lit("\n255\n"))
    return F.concat(F.encode(header, "UTF-8"), payload)


def from_media(media: bytes) -> bytes:
    """The samples of a binary PGM."""
    magic, size, depth, samples = media.split(b"\n", 3)
    wide, high = map(int, size.split())
    if magic != b"P5" or depth != b"255" or wide * high != len(samples):
        raise ValueError("not a binary PGM of 8 bits")
    return samples


def media_store(payloads: DataFrame, digest_col: str, payload_col: str) -> DataFrame:
    """(digest, media): each distinct payload once. Copies are dropped before the shuffle and again after it."""
    return payloads.groupBy(F.col(digest_col).alias("digest")).agg(F.first(payload_col).alias("payload")).select("digest", to_media(F.col("payload")).alias("media"))


def media_features(store: DataFrame) -> DataFrame:
    """(digest, FEATURES) from the stored bytes alone. feature: mean, standard deviation, mean step between neighbours, a 16-bin histogram in per mille, and a 64-bit difference hash of column means."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for media in batch.column(1).to_pylist():
                payload = from_media(media)
                x = np.frombuffer(payload, np.uint8)
                bins = np.bincount(x >> 4, minlength=16) * 1000 // len(x)
                means = x.reshape(-1, LINE).mean(axis=0)
                bits = int.from_bytes(np.packbits(means > np.roll(means, 1)).tobytes(), "big")
                step = np.abs(np.diff(x.astype(np.int16))).mean()
                feature = f"{x.mean():.4f};{x.std():.4f};{step:.4f};{','.join(map(str, bins))};{bits:016x}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-LINE:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["digest", *(f.split()[0] for f in FEATURES.split(", "))])

    return store.mapInArrow(read, f"digest string, {FEATURES}")


def resolve(sequence: DataFrame, store: DataFrame) -> DataFrame:
    """Media rows of a sequence with the columns of the store; a hot digest is split by the skew join."""
    return sequence.where("kind = 'media'").join(store, F.col("media_digest") == F.col("digest"), "left").drop("digest")


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a page: its text as a paragraph, then a figure whose payload is the text's bytes."""
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", data.alias("data")).withColumn("payload", padded(F.col("data")))
    docs = docs.withColumn("digest", F.sha2("payload", 256))
    escaped = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    caption = F.concat(F.length("data").cast("string"), F.lit(" bytes"))
    page = F.concat(F.lit("<article><p>"), escaped, F.lit(f'</p><figure><img src="{SCHEME}'), F.col("digest"), F.lit('"><figcaption>'), caption, F.lit("</figcaption></figure></article>"))
    sequence = interleave(docs.select("doc_id", page.alias("html")), "doc_id", "html", keep_text=False)
    found = resolve(sequence, media_features(media_store(docs, "digest", "payload")))
    n_bytes = F.element_at(F.split("caption", " "), 1).cast("long").alias("n_bytes")
    return found.select(F.col("id").alias("doc_id"), n_bytes, *(f.split()[0] for f in FEATURES.split(", ")), "position", "caption")
