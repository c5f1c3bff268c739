"""Interleaved document sequences: text and media of HTML pages in order.

Parsing yields, for every page, an ordered array of structs: texts, and media
references with their captions and alternative texts.  A reference names its
payload by SHA-256 digest ("sha256:..."); a join on the digest resolves it
against a media store and keeps places and captions.  The store holds media as
binary PGM images, 8 bits a sample, SIDE samples a line, the number of bytes
before padding in a comment.

A video or audio without src has that of its first source element, as its place
is one; an img without src has the first candidate of its srcset, or else of the
first source of its picture.  A poster is an image before its video.  Further
sources and candidates show the same medium and are not references.

Edge cases: a null or empty page has an empty sequence; references that name no
digest, or one that the store lacks, stay unresolved (null payload columns);
repeated payloads are stored once for each batch that meets them and resolved
once; unclosed tags end with the page; pages of any length are parsed whole;
other columns are not read whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import scratch_path, written

SIDE = 24
UNIT = SIDE * SIDE
PAD = 255
PAGES = 500
SKIP = frozenset({"script", "style", "template", "noscript"})
BREAK = frozenset("address article aside blockquote body br dd div dl dt footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th title tr ul".split())
MEDIA = {"img": "image", "video": "video", "audio": "audio"}
SEQUENCE = "array<struct<position:int, kind:string, text:string, ref:string, alt:string, caption:string>>"
_ITEM = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("alt", pa.string()), ("caption", pa.string())])


def _candidate(srcset: str | None) -> str | None:
    """First candidate of a srcset."""
    return next((c for c in (part.strip(",") for part in (srcset or "").split()) if c), None)


class _Interleaver(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.skipped = 0
        self.figure: list[int] | None = None
        self.caption: list[str] | None = None
        self.player: int | None = None
        self.picture: str | None = None

    def _close_text(self) -> None:
        if text := " ".join("".join(self.words).split()):
            self._add(kind="text", text=text)
        self.words.clear()

    def _add(self, **item: str | None) -> None:
        self.items.append({"position": len(self.items), "text": None, "ref": None, "alt": None, "caption": None} | item)

    def _medium(self, **item: str | None) -> None:
        if self.figure is not None:
            self.figure.append(len(self.items))
        self._add(**item)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in SKIP:
            self.skipped += 1
        elif tag in MEDIA:
            self._close_text()
            named = dict(attrs)
            ref = named.get("src")
            if tag == "img":
                ref = ref or _candidate(named.get("srcset")) or self.picture or ref
            elif named.get("poster"):
                self._medium(kind="image", ref=named["poster"])
            self._medium(kind=MEDIA[tag], ref=ref, alt=named.get("alt"))
            if tag != "img":
                self.player = len(self.items) - 1
        elif tag == "source":
            named = dict(attrs)
            if self.player is not None:
                self.items[self.player]["ref"] = self.items[self.player]["ref"] or named.get("src")
            elif self.picture is not None:
                self.picture = self.picture or _candidate(named.get("srcset")) or named.get("src") or ""
        elif tag == "picture":
            self.picture = ""
        elif tag == "figure":
            self._close_text()
            self.figure = []
        elif tag == "figcaption":
            self._close_text()
            self.caption = []
        elif tag in BREAK:
            self._close_text()

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIP:
            self.skipped = max(0, self.skipped - 1)
        elif tag in ("video", "audio"):
            self.player = None
        elif tag == "picture":
            self.picture = None
        elif tag == "figcaption" and self.caption is not None:
            self._close_caption()
        elif tag == "figure":
            self._close_caption()
            self._close_text()
            self.figure = None
        elif tag in BREAK:
            self._close_text()

    def _close_caption(self) -> None:
        text = " ".join("".join(self.caption or ()).split())
        self.caption = None
        if text and self.figure:
            for k in self.figure:
                self.items[k]["caption"] = text
        elif text:
            self._add(kind="text", text=text)

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            (self.words if self.caption is None else self.caption).append(data)

    def result(self) -> list[dict]:
        self.close()
        self._close_caption()
        self._close_text()
        return self.items


def interleave(html: Column) -> Column:
    """Ordered sequence of a page's texts and media references."""

    @F.arrow_udf(SEQUENCE)
    def parsed(column: pa.Array) -> pa.Array:
        out = [pa.array([], pa.list_(_ITEM))]
        for a in range(0, len(column), PAGES):
            rows = []
            for page in column.slice(a, PAGES).to_pylist():
                parser = _Interleaver()
                parser.feed(page or "")
                rows.append(parser.result())
            out.append(pa.array(rows, pa.list_(_ITEM)))
        return pa.concat_arrays(out)

    return parsed(html)


def page_of(text: Column, ref: Column, alt: Column, caption: Column) -> Column:
    """An HTML page: a paragraph for every line of text, then a figure with the medium ref."""
    escape = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    body = F.replace(escape(F.coalesce(text, F.lit(""))), F.lit("\n"), F.lit("</p><p>"))
    return F.concat(F.lit("<article><p>"), body, F.lit('</p><figure><img src="'), ref, F.lit('" alt="'), escape(alt), F.lit('"><figcaption>'), escape(caption), F.lit("</figcaption></figure></article>"))


def media_refs(pages: DataFrame, id_col: str, sequence_col: str = "sequence") -> DataFrame:
    """One row per media reference: page, position, kind, digest (null if it names none), alt and caption."""
    item = pages.select(F.col(id_col), F.explode(sequence_col).alias("item")).filter("item.kind <> 'text'")
    digest = F.nullif(F.regexp_extract("item.ref", "^sha256:([0-9a-f]{64})$", 1), F.lit(""))
    return item.select(id_col, "item.position", "item.kind", digest.alias("digest"), "item.alt", "item.caption")


def resolve(refs: DataFrame, media: DataFrame) -> DataFrame:
    """refs with the columns of media joined by digest.

    One row a digest is written first, so that Spark may split a digest with very many references."""
    return refs.join(written(media.dropDuplicates(["digest"]), "media-by-digest"), "digest", "left")


def to_pgm(payload: bytes, size: int) -> bytes:
    """payload, a positive multiple of UNIT, as a binary grey map of SIDE samples a line; size bytes of it are content."""
    return b"P5\n# %d bytes\n%d %d\n255\n" % (size, SIDE, len(payload) // SIDE) + payload


def from_pgm(stored: bytes) -> tuple[bytes, int]:
    """The samples, and how many of them are content."""
    magic, note, shape, most, samples = stored.split(b"\n", 4)
    width, height = map(int, shape.split())
    if magic != b"P5" or most != b"255" or len(samples) != width * height:
        raise ValueError("not a grey map of 8-bit samples")
    return samples, int(note.split()[1])


def padded(content: bytes) -> bytes:
    return content + bytes([PAD]) * (-len(content) % UNIT or (0 if content else UNIT))


def features(samples: bytes) -> str:
    """Mean and spread of the samples and shares of eight equal ranges of values, as text."""
    values = np.frombuffer(samples, np.uint8)
    counts = np.bincount(values, minlength=256)
    n, grid = len(values), np.arange(256)
    mean = float(counts @ grid) / n
    spread = (float(counts @ (grid * grid)) / n - mean * mean) ** 0.5
    return f"mean={mean:.4f};sd={spread:.4f};hist=" + ",".join(f"{c / n:.4f}" for c in counts.reshape(8, 32).sum(axis=1))


def _store_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, stored, seen, size = [], [], set(), 0
        for content in batch.column(0).to_pylist():
            digest = hashlib.sha256(content).hexdigest()
            if digest not in seen:
                seen.add(digest)
                digests.append(digest)
                stored.append(to_pgm(padded(content), len(content)))
                size += len(stored[-1])
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(digests), pa.array(stored, pa.binary())], names=["digest", "media"])
                digests, stored, size = [], [], 0
        if digests:
            yield pa.RecordBatch.from_arrays([pa.array(digests), pa.array(stored, pa.binary())], names=["digest", "media"])


def store(contents: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the one binary column of contents as media named by the content's digest; returns the stored table.

    No shuffle: each task writes what it reads, each digest once for a batch."""
    path = path or scratch_path(contents.sparkSession, "media")
    contents.mapInArrow(_store_task, "digest string, media binary").write.option("compression", "zstd").parquet(path)
    return contents.sparkSession.read.schema("digest string, media binary").parquet(path)


MEASURES = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _measure_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for media in batch.column(1).to_pylist():
            payload, size = from_pgm(media)
            rows.append((size, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), features(payload)))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["digest", *(m.split()[0] for m in MEASURES.split(", "))])


def measured(media: DataFrame) -> DataFrame:
    """Decodes the stored bytes of each medium: payload, its digest, tail checksum and features, without the bytes."""
    return media.select("digest", "media").mapInArrow(_measure_task, "digest string, " + MEASURES)
