"""TEI documents: header metadata and the texts of their chunks."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from datetime import date
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements that hold a chunk of text, and those that stand for white space.
CHUNKS = frozenset(
    """ab annotationBlock argument bibl biblFull biblStruct byline camera caption castList cit closer dateline desc
    docAuthor docDate eTree entry entryFree epigraph floatingText forest graph head l label lg list listApp listBibl
    listEvent listForest listNym listObject listOrg listPerson listPlace listRelation listWit meeting move msDesc opener
    p postscript q quote said salute signed sound sp spGrp stage superEntry table tech trailer tree u view""".split()
)
BREAKS = frozenset(["cb", "lb", "pb"])
SCHEMA = (
    "doc_id string, collection string, par_no int, text string, bibl string, url string, accessed string, date string, year int, "
    "text_classes array<string>, country string, metaarea string, area string, subarea string"
)


def local(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def every(e: ET.Element, *path: str) -> Iterator[ET.Element]:
    """Descendants along a path of names, any number of levels between two of them."""
    found = [e]
    for name in path:
        found = [x for top in found for x in top.iter() if local(x) == name]
    return iter(found)


def words(e: ET.Element) -> str:
    """Text with single spaces; breaks are spaces unless they say no; what follows the element is not its text."""
    parts: list[str] = []

    def walk(x: ET.Element) -> None:
        if local(x) in BREAKS and x.get("break") != "no":
            parts.append(" ")
        parts.append(x.text or "" if isinstance(x.tag, str) else "")
        for child in x:
            walk(child)
            parts.append(child.tail or "")

    walk(e)
    return re.sub(r"\s+", " ", "".join(parts)).strip()


def chunks(e: ET.Element) -> Iterator[ET.Element]:
    """Outermost chunks below body."""

    def walk(x: ET.Element, inside: bool) -> Iterator[ET.Element]:
        for child in x:
            body = inside or local(child) == "body"
            if inside and local(child) in CHUNKS:
                yield child
            else:
                yield from walk(child, body)

    return walk(e, False)


def iso(s: str | None) -> str | None:
    try:
        return s if s and date.fromisoformat(s) else None
    except ValueError:
        return None


def metadata(header: ET.Element) -> dict:
    """What a header says; of several values the first one counts, text classes are gathered."""
    out: dict = {}

    def first(key: str, value: str | None) -> None:
        if value and not out.get(key):
            out[key] = value

    for note in every(header, "fileDesc", "notesStmt", "note"):
        if note.get("type", "ddc") == "ddc":
            for idno in every(note, "idno"):
                if idno.get("type", "bibl") == "bibl":
                    first("bibl", words(idno))
    published = downloaded = None
    for source in every(header, "fileDesc", "sourceDesc"):
        if source.get("n", "ddc") != "ddc" or source.get("id", "orig") != "orig":
            continue
        for stmt in every(source, "biblFull", "publicationStmt"):
            for d in every(stmt, "date"):
                if d.get("type", "first") in ("first", "publication"):
                    published = published or words(d)
            for ptr in every(stmt, "ptr"):
                if ptr.get("type") == "URL":
                    first("url", ptr.get("target"))
        for bibl in every(source, "bibl"):
            first("bibl", words(bibl))
    classes = {words(x) for name in ("keyword", "keywords") for x in every(header, "profileDesc", "textClass", name, "term")}
    classes |= {words(x) for x in every(header, "profileDesc", "textClass", "classCode")}
    for place in every(header, "profileDesc", "settingDesc", "place"):
        for country in every(place, "country"):
            first("country", words(country))
        for region in every(place, "region"):
            kind = region.get("type")
            key = kind if kind in ("metaarea", "subarea") and not out.get(kind) else "area"
            first(key, words(region))
    for d in every(header, "profileDesc", "creation", "date"):
        if d.get("type") == "download":
            downloaded = downloaded or words(d)
    if (raw := published or downloaded) and (m := re.match(r"\d{4}", raw)):
        out["year"] = int(m[0])
    out["accessed"], out["date"] = iso(downloaded), iso(published) or iso(downloaded)
    out["text_classes"] = sorted(c for c in classes if c) or None
    return out


def documents(collection: str, path: str, data: bytes) -> list[dict]:
    """Rows for the chunks with text of all TEI elements of a file; a corpus header is overridden by inner headers."""
    try:
        root = ET.fromstring(data)
    except ET.ParseError:
        return []
    rows, urn, n = [], f"urn:corpus:{collection}:{quote(path)}", 0

    def header_of(e: ET.Element) -> dict:
        return {k: v for child in e if local(child) == "teiHeader" for k, v in metadata(child).items() if v}

    def walk(e: ET.Element, meta: dict) -> None:
        nonlocal n
        if local(e) == "teiCorpus":
            meta = meta | header_of(e)
            for child in e:
                walk(child, meta)
        elif local(e) == "TEI":
            n += 1
            own = meta | header_of(e)
            texts = [t for t in map(words, chunks(e)) if t]
            for i, text in enumerate(texts, 1):
                rows.append(own | {"doc_id": urn + (f"/d{n}" if n > 1 else ""), "collection": collection, "par_no": i, "text": text})

    walk(root, {})
    return rows


def read(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """Chunk rows of all .xml files below path; a file that is no XML gives none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path)
    root = path.rstrip("/").split("://")[-1]
    rel = F.regexp_replace("path", "^[a-z]+:/+", "/")
    return extract(files.select(rel.alias("path"), "content"), collection, root)


def extract(files: DataFrame, collection: str, root: str = "") -> DataFrame:
    """files (path, content binary) to rows of SCHEMA."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r for p, c in zip(frame.path, frame.content, strict=True) for r in documents(collection, p.removeprefix(root).lstrip("/"), bytes(c))]
            yield pd.DataFrame([[r.get(k) for k in names] for r in rows], columns=names)

    return files.mapInPandas(run, SCHEMA)


def page_text(html: pd.Series) -> pd.Series:
    """Texts of HTML pages without scripts and styles, white space collapsed."""
    from html import unescape

    def one(s: str | None) -> str | None:
        if s is None:
            return None
        s = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", s)
        return re.sub(r"\s+", " ", unescape(re.sub(r"(?s)<[^>]*>", " ", s))).strip()

    return html.map(one)
