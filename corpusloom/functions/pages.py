"""Crawled pages: titles, links, context objects, assets, chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scoring import host, path
from .textkit import or_default, strip

MOST_CHARS = 50_000
EXTENSIONS = {"pdf": "pdf", "image": "webp|tiff|bmp|gif|png|jpe?g", "html": "html?", "document": "rtf|txt|docx?"}


def elements(html: Column, tags: str) -> Column:
    """Texts of all elements of the given tags, tags inside removed."""
    found = F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{tags})(?:\s[^>]*)?>(.*?)</(?:{tags})\s*>"), F.lit(1))
    return F.transform(found, lambda x: strip(F.regexp_replace(x, "<[^>]*>", "")))


def of_class(html: Column, name: str) -> Column:
    """Texts of elements that carry a class; an element ends at the first closing tag of its kind."""
    found = F.regexp_extract_all(html, F.lit(rf"""(?is)<([a-z]\w*)\s[^>]*?class\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'][^>]*>(.*?)</\1\s*>"""), F.lit(2))
    return F.transform(found, lambda x: strip(F.regexp_replace(x, "<[^>]*>", "")))


def extracted(html: Column) -> Column:
    """struct<title, content, date>: the first heading, all paragraphs and the first date of a page."""
    content = F.concat(paragraphs(html), of_class(html, "content"))
    date = F.get(F.concat(of_class(html, "date"), dates(html)), F.lit(0))
    return F.struct(title(html).alias("title"), F.array_join(content, "\n").alias("content"), date.alias("date"))


def title(html: Column) -> Column:
    return F.get(elements(html, "h1|h2"), F.lit(0))


def paragraphs(html: Column) -> Column:
    return elements(html, "p|article")


def dates(html: Column) -> Column:
    return elements(html, "time")


def links(html: Column) -> Column:
    """Targets of all anchors, in order."""
    return F.regexp_extract_all(html, F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))


def images(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?is)<img\s[^>]*?src\s*=\s*["']([^"']*)["']"""), F.lit(1))


def videos(html: Column) -> Column:
    """Sources of all video elements, their own or those of the sources inside."""
    return F.regexp_extract_all(html, F.lit(r"""(?is)<(?:video|source)\s[^>]*?src\s*=\s*["']([^"']*)["']"""), F.lit(1))


def _absolute(x: Column) -> Column:
    return x.rlike("(?i)^https?://")


def context_object(url: Column, html: Column, source: dict[str, str] | None = None) -> Column:
    """struct<content, provenance>: strings cut at 50,000 characters, link and media lists at their limits."""
    config = source or {}
    here = host(url)
    found = links(html)
    inside = F.filter(found, lambda x: ~_absolute(x) | (host(x) == here))
    outside = F.filter(found, lambda x: _absolute(x) & (host(x) != here))
    content = F.struct(
        F.substring(html, 1, MOST_CHARS).alias("html"),
        F.substring(F.regexp_replace(html, "(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", ""), 1, MOST_CHARS).alias("cleaned_html"),
        F.substring(F.array_join(paragraphs(html), "\n\n"), 1, MOST_CHARS).alias("markdown"),
        F.struct(F.slice(images(html), 1, 10).alias("images"), F.slice(videos(html), 1, 5).alias("videos")).alias("media"),
        F.struct(F.slice(inside, 1, 20).alias("internal"), F.slice(outside, 1, 10).alias("external")).alias("links"),
    )
    provenance = F.struct(
        F.lit(config.get("source_id")).cast("string").alias("source_id"), or_default(F.lit(config.get("agency")).cast("string"), "Unknown").alias("source_agency"),
        url.alias("source_url"), F.lit("HTML").alias("original_format"), F.lit(float(config.get("reliability", 0.9))).alias("reliability_score"), here.alias("domain"),
    )
    named = lambda n: F.regexp_extract(html, rf"""(?is)<meta\s[^>]*?name\s*=\s*["']{n}["'][^>]*?content\s*=\s*["']([^"']*)["']""", 1)
    metadata = F.struct(
        F.trim(F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"), named("description").alias("description"), named("keywords").alias("keywords"),
        or_default(F.regexp_extract(html, r"""(?is)<html\s[^>]*?lang\s*=\s*["']([^"']*)["']""", 1), "si").alias("language"), F.lit(config.get("source_id")).cast("string").alias("source_id"),
    )
    no = F.lit(False)  # a page is new, and HTML needs no OCR; later stages set the rest through the table's patches
    status = F.struct(no.alias("ocr_required"), no.alias("language_detected"), no.alias("entities_extracted"), no.alias("translated"))
    return F.struct(content.alias("content"), provenance.alias("provenance"), metadata.alias("metadata"), status.alias("processing_status"))


def asset_type(url: Column, content_type: Column | None = None) -> Column:
    """pdf, image, html, document or unknown, by content type and then by the path's ending."""
    kind = F.lower(F.coalesce(content_type, F.lit(""))) if content_type is not None else F.lit("")
    p = F.lower(path(url))
    name = F.regexp_extract(p, r"([^/]*)/*$", 1)
    out = F.when(F.contains(kind, F.lit("pdf")), "pdf").when(F.contains(kind, F.lit("image")), "image").when(F.contains(kind, F.lit("html")), "html")
    for asset, ending in EXTENSIONS.items():
        out = out.when(p.rlike(rf"\.(?:{ending})$"), asset)
    return out.when(~name.rlike(r"^.+\.[^.]+$"), "html").otherwise("unknown")


def segregate(internal: Column, media: Column, priority: Column | str = "medium") -> Column:
    """struct<pdf_links, image_links, other_documents, counts, ocr_required> of a page's links and media.

    Every media image becomes an entry, also one that is linked.
    """
    level = F.lit(priority) if isinstance(priority, str) else priority
    of = lambda kind: F.filter(internal, lambda x: asset_type(x) == kind)

    def row(x: Column, ocr: bool, convert: bool, level: Column) -> Column:
        return F.struct(x.alias("url"), F.lit(True).alias("needs_download"), F.lit(ocr).alias("needs_ocr"), F.lit(convert).alias("needs_conversion"), level.cast("string").alias("priority"))

    pdf = F.transform(of("pdf"), lambda x: row(x, True, False, level))
    linked = F.transform(of("image"), lambda x: row(x, True, False, F.lit(None)))
    shown = F.transform(media, lambda x: row(x, False, False, F.lit("low")))
    other = F.transform(of("document"), lambda x: row(x, False, True, F.lit(None)))
    pictures = F.concat(linked, shown)
    counts = F.struct(F.size(pdf).alias("pdf"), F.size(pictures).alias("images"), F.size(other).alias("documents"))
    ocr = (F.size(pdf) > 0) | F.exists(pictures, lambda x: x["needs_ocr"])
    return F.struct(pdf.alias("pdf_links"), pictures.alias("image_links"), other.alias("other_documents"), counts.alias("counts"), ocr.alias("ocr_required"))


def chunks(text: Column, least_words: int = 10) -> Column:
    """Pieces between blank lines that have enough words."""
    return F.filter(F.split(text, "\n\n", -1), lambda c: F.size(F.filter(F.split(strip(c), r"\s+", -1), lambda w: F.length(w) > 0)) >= least_words)


def storage_path(kind: Column, context_id: Column, url: Column) -> Column:
    """Where an asset is stored: type, context and the URL's last part, query and all."""
    return F.concat_ws("/", F.concat(kind, F.lit("s-raw")), context_id, F.element_at(F.split(url, "/", -1), -1))
