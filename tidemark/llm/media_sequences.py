"""Media columns: interleaved sequences of text and media references, resolved by digest."""

from __future__ import annotations

import hashlib
import html as html_lib
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, stored, table

TILE = 576
WIDTH = 24
PARTS = "array<struct<position:int,kind:string,text:string,src:string,digest:string,caption:string>>"

_NAME = re.compile(r"[a-zA-Z][a-zA-Z0-9]*")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_SPACE = re.compile(r"\s+")
MEDIA_TAGS = {"img", "video", "audio", "source"}
BREAKING = {"p", "figcaption", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "article", "section", "figure", "nav", "blockquote", "pre", "title", "body", "head", "html"}


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, lower-cased name, closing, attributes) of the tags of a page, in one walk over it.

    Comments, declarations, scripts and styles have the name "". One that is never closed runs to the end of the
    page, as does a script; a ``<`` after which no ``>`` comes is text. A quoted value may hold ``>``; a quote
    without its like after it is an ordinary character. What has been sought in vain once is not sought again, so
    time is linear whatever the page.
    """
    at, size = 0, len(page)
    absent: set[str] = set()

    def seek(what: str, start: int, text: str = page) -> int:
        if what in absent:
            return -1
        found = text.find(what, start)
        if found < 0:
            absent.add(what)
        return found

    lowered = ""
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = seek("-->", at + 4)
            end = size if end < 0 else end + 3
            yield at, end, "", False, ""
            at = end
            continue
        name = _NAME.match(page, at + 1 + page.startswith("/", at + 1))
        if not name and not page.startswith("!", at + 1):
            at += 1
            continue
        end = name.end() if name else at + 2
        stop = _STOP.search(page, end)
        while stop and stop.group() != ">":
            quote, end = stop.group(), stop.end()
            # a value's quote stands after its equals sign, with white space at most between them
            close = seek(quote, end) if page[max(stop.start() - 16, 0) : stop.start()].rstrip().endswith("=") else -1
            stop = _STOP.search(page, close + 1 if close >= 0 else end)
        if not stop:
            return
        tag, closing, end = (name.group().lower() if name else ""), page.startswith("/", at + 1), stop.end()
        if tag in ("script", "style") and not closing:
            lowered = lowered or (page.lower() if page.isascii() else page.translate(_LOWER))
            close = seek(f"</{tag}", end, lowered)
            close = page.find(">", close) if close >= 0 else -1
            end, tag = (close + 1 if close >= 0 else size), ""
        yield at, end, tag, closing, page[name.end() : stop.start()] if name and tag in MEDIA_TAGS else ""
        at = end


_LOWER = {c: c + 32 for c in range(65, 91)}


def _folded(pieces: list[str]) -> str:
    return _SPACE.sub(" ", html_lib.unescape("".join(pieces))).strip()


def parse_html(page: str | None) -> list[dict]:
    """Ordered text and media parts of a page, in time linear in its length.

    Text between block tags makes one part, white space folded, entities decoded; scripts, styles and comments
    are left out. A media element makes a part at its place; its caption is the ``figcaption`` of the figure it
    stands in, else its ``alt`` text; a figure without media leaves its caption as text. A caption ends with its own tag or its figure; one that neither ends takes the
    text up to the next block tag, and one outside a figure is ordinary text. Of several captions of a figure
    the last one holds. A ``digest:`` source or a ``data-digest`` attribute names the payload.
    """
    parts: list[dict] = []
    buffer: list[str] = []
    figure: list[dict] | None = None
    told: str | None = None  # the open figure's caption
    caption: int | None = None  # the place in ``parts`` from which texts belong to the open caption

    def flush() -> None:
        text = _folded(buffer)
        buffer.clear()
        if text:
            parts.append({"kind": "text", "text": text, "src": None, "digest": None, "caption": None})

    def close_caption(whole: bool = True) -> None:
        nonlocal caption, told
        flush()
        tail = parts[caption:]
        texts = [p for p in tail if p["kind"] == "text"][: None if whole else 1]
        taken = set(map(id, texts))
        parts[caption:] = [p for p in tail if id(p) not in taken]
        caption = None
        told = " ".join(p["text"] for p in texts) or told
        for part in figure or () if told else ():
            part["caption"] = told

    def close_figure() -> None:
        nonlocal told, figure
        if caption is not None:
            close_caption()
        flush()
        if told and not figure:
            parts.append({"kind": "text", "text": told, "src": None, "digest": None, "caption": None})
        told = figure = None

    at, page = 0, page or ""
    for start, end, tag, closing, attributes in tags(page):
        buffer.append(page[at:start])
        at = end
        if tag == "figcaption" and figure is not None:
            if caption is not None:
                close_caption()
            flush()
            caption = None if closing else len(parts)
        elif tag in MEDIA_TAGS and not closing:
            attrs = {k.lower(): html_lib.unescape(next((x for x in v if x), "")) for k, *v in _ATTR.findall(attributes)}
            if src := attrs.get("src"):
                flush()
                digest = attrs.get("data-digest") or (src[7:] if src.startswith("digest:") else None)
                parts.append({"kind": "media", "text": None, "src": src, "digest": digest, "caption": told or attrs.get("alt") or None})
                if figure is not None:
                    figure.append(parts[-1])
        elif tag == "figure":
            close_figure()
            figure = None if closing else []
        elif tag in BREAKING:
            flush()
    buffer.append(page[at:])
    if caption is not None:
        close_caption(whole=False)
    close_figure()
    return [{"position": i, **p} for i, p in enumerate(parts)]


def interleaved_sequences(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, parts): the ordered parts of each page as structs. Null and empty pages have no parts; rows are kept
    one by one, whatever their ids; other columns are ignored."""
    import pyarrow as pa

    pages = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
    kind = pages.schema["id"].dataType.simpleString()
    struct = pa.struct([("position", pa.int32()), *((n, pa.string()) for n in ("kind", "text", "src", "digest", "caption"))])

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = batch.slice(lo, 256)
                found = pa.array([parse_html(x) for x in rows.column(1).to_pylist()], pa.list_(struct))
                yield pa.RecordBatch.from_arrays([rows.column(0), found], names=["id", "parts"])

    return pages.mapInArrow(run, f"id {kind}, parts {PARTS}")


def resolve_media(sequences: DataFrame, media: DataFrame) -> DataFrame:
    """Attach media to the parts by digest: (id, parts) with a struct ``media`` added to every part.

    ``media`` has a ``digest`` column; its other columns make the struct, null for text parts and for unknown
    digests. Of rows of one digest one is taken. Parts keep their positions and captions.
    """
    fields = [c for c in media.columns if c != "digest"]
    media = stored(media.dropDuplicates(["digest"]).where("digest IS NOT NULL").select("digest", F.struct(*fields).alias("media")), "media-by-digest")
    flat = sequences.withColumn("row", F.monotonically_increasing_id()).select("row", "id", F.explode_outer("parts").alias("p")).withColumn("digest", F.col("p.digest"))
    met = flat.join(media, "digest", "left")
    part = F.when(F.col("p").isNotNull(), F.struct("p.position", "p.kind", "p.text", "p.src", "p.digest", "p.caption", "media"))
    return met.groupBy("row", "id").agg(F.array_sort(F.collect_list(part)).alias("parts")).select("id", "parts")


# -- the stored form: 8-bit grey samples, 24 to a line, as a binary portable grey map


def payload_of(text: Column) -> Column:
    """UTF-8 bytes of a text (null: empty), filled with bytes 255 up to a positive multiple of 576."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    size = F.greatest(F.ceil(F.octet_length(raw) / TILE), F.lit(1)) * TILE
    return F.concat(raw, F.unhex(F.repeat(F.lit("FF"), (size - F.octet_length(raw)).cast("int"))))


def stored_form(payload: Column) -> Column:
    head = F.concat(F.lit(f"P5\n{WIDTH} "), (F.octet_length(payload) / WIDTH).cast("long").cast("string"), F.lit("\n255\n"))
    return F.concat(head.cast("binary"), payload)


def read_samples(stored_bytes: bytes) -> np.ndarray:
    """The samples of a binary grey map, by line."""
    magic, size, most, data = stored_bytes.split(b"\n", 3)
    width, height = map(int, size.split())
    if magic != b"P5" or most != b"255" or len(data) != width * height:
        raise ValueError("not a binary grey map of 8-bit samples")
    return np.frombuffer(data, np.uint8).reshape(height, width)


def sample_features(x: np.ndarray) -> str:
    """Mean, deviation, gradients along and across lines, and a 16-bin histogram, as a string of rounded numbers."""
    y = x.astype(np.float32)
    across = np.abs(np.diff(y, axis=1)).mean()
    along = np.abs(np.diff(y, axis=0)).mean() if len(y) > 1 else 0.0
    bins = np.bincount(x.ravel() >> 4, minlength=16) / x.size
    return " ".join(f"{v:.4f}" for v in (y.mean(dtype=np.float64), y.std(dtype=np.float64), across, along, *bins))


def describe_media(media: DataFrame) -> DataFrame:
    """digest, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 and feature of (digest, data)."""

    def describe(digest, data):
        out: dict = {"digest": digest, "payload_bytes": [], "payload_sha256": [], "tail_crc32": [], "media_bytes": [], "media_sha256": [], "feature": []}
        for d in data:
            x = read_samples(d)
            payload = x.tobytes()
            out["payload_bytes"].append(len(payload))
            out["payload_sha256"].append(hashlib.sha256(payload).hexdigest())
            out["tail_crc32"].append(zlib.crc32(payload[-32:]))
            out["media_bytes"].append(len(d))
            out["media_sha256"].append(hashlib.sha256(d).hexdigest())
            out["feature"].append(sample_features(x))
        return out

    return map_rows(media.select("digest", "data"), describe, "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", 64)


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a page whose figure refers by digest to the grey map that holds its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("data", stored_form(payload_of(F.col("text"))))
    docs = docs.withColumn("digest", F.sha2("data", 256))
    media = describe_media(docs.select("digest", "data"))  # copies meet as rows of features: no payload is shuffled
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("string")
    page = F.concat(F.lit("<article><p>stored text</p><figure><img src=\"digest:"), F.col("digest"), F.lit("\"><figcaption>"), size, F.lit(" bytes</figcaption></figure></article>"))
    found = resolve_media(interleaved_sequences(docs.select("doc_id", page.alias("html")), id_col="doc_id"), media)
    part = found.select(F.col("id").alias("doc_id"), F.explode("parts").alias("p")).where("p.kind = 'media'")
    return part.select("doc_id", F.regexp_extract("p.caption", r"^\d+", 0).cast("long").alias("n_bytes"), "p.media.*")


CHARTS = 97


def pages_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as sequences, each with a figure set in after its heading whose payload another table holds by digest.

    Per page: its parts, the figure's position, caption and payload size, and a digest of the texts in order.
    """
    payload = lambda k: F.sha2(F.concat(F.lit("chart "), k.cast("string")).cast("binary"), 256)
    k = F.pmod(F.col("page_id"), F.lit(CHARTS))
    figure = F.concat(F.lit('</h1><figure><img alt="chart" src="digest:'), payload(k), F.lit('"><figcaption>Chart <b>'), k.cast("string"), F.lit("</b> of the page</figcaption></figure>"))
    at = F.instr("html", "</h1>")
    pages = table(spark, sf_dir, "pages").select("page_id", F.when(at > 0, F.concat(F.substring("html", F.lit(1), at - 1), figure, F.substring("html", at + 5, F.length("html")))).otherwise(F.col("html")).alias("html"))
    media = spark.range(CHARTS).select(payload(F.col("id")).alias("digest"), (F.col("id") * 100).alias("size"))
    found = resolve_media(interleaved_sequences(pages), media)
    chart = F.get(F.filter("parts", lambda p: p["kind"] == "media"), F.lit(0))
    texts = F.transform(F.filter("parts", lambda p: p["kind"] == "text"), lambda p: p["text"])
    return found.select(
        F.col("id").alias("page_id"), F.size("parts").cast("long").alias("n_parts"), F.size(texts).cast("long").alias("n_texts"), chart["position"].alias("position"), chart["caption"].alias("caption"), chart["media"]["size"].alias("size"),
        F.sha2(F.array_join(texts, "\n").cast("binary"), 256).alias("texts_sha256"),
    )
